"""Language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary: a target model of documents labelled good and a background model of all
documents. A document's score is its cross-entropy under the target model less that under the background model,
per token, its end counted as a token: low scores mean text like the target's.

Vocabulary: all words (A-Z lower-cased) with at least two occurrences in all documents; any other word is one
unknown word. Words and bigrams are counted exactly over all documents, and over all labelled good. Probabilities are
(c(ab) + M p(b)) / (c(a) + M), with p(b) from word counts, half a count added for each. A word is as often a history
as it is a token, a text's edge included, so c(a) is its word count.

Texts are split once, into blocks of about ``TOKENS`` tokens with their own word numbers. A block sends its distinct
words and later its distinct bigrams, each with its counts, to parts by hash; a part adds up what all blocks sent
and answers every block in the order of its request. The number of parts and of blocks grows with the input, so a task
holds a block or a part whatever the size, and nothing but totals reaches the driver. A common word or bigram is
one entry a block.

Defined cases: a null or empty text is its end alone. Without target documents both models are the background.
Repeated rows get equal rows, an empty table none. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidlake.operators.joins import small
from braidlake.runtime import map_arrow, materialize

from .common import pieces, texts_of

#: Ids before those of words: a text's edge, the unknown word.
EDGE, UNKNOWN = 0, 1
FIRST = 2
#: A block is closed at so many tokens; a single text is never cut.
TOKENS = 1 << 20
#: Distinct words a task holds before it sends their counts.
HELD = 400_000
M = 16.0


def words_in(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def vocabulary(docs: DataFrame, size: int) -> list[bytes]:
    """The commonest words of all whole texts, for a look at a corpus; the models keep every word that occurs twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for piece in pieces(batches):
            for text in texts_of(piece):
                held.update(words_in(text))
            if len(held) > HELD:
                yield out()
        yield out()

    rows = map_arrow(docs.select(F.col("text").cast("string")), count, "word binary, n long")
    counted = materialize(rows.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2"), "words")
    # from which count on there are at most ``size`` words; one row a distinct count is ordered
    per = counted.groupBy("n").agg(F.count("*").alias("words")).withColumn("upto", F.sum("words").over(Window.orderBy(F.desc("n"))))
    least = per.where(F.col("upto") <= size).agg(F.min("n")).first()[0]
    if least is None:
        return []
    return sorted(bytes(r.word) for r in counted.where(F.col("n") >= least).select("word").collect())


def squeezed(raw: bytes) -> bytes:
    """Compressed, after its size."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True) if raw else b""


def shut(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, those of equal place together."""
    return squeezed(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) if len(x) else b""


def opened(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(unsqueezed(raw), np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def shut_keys(keys: np.ndarray) -> bytes:
    """Ascending bigrams, of whose first words the steps are kept."""
    return shut(np.diff(keys >> np.uint64(32), prepend=np.uint64(0)) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF))


def opened_keys(raw: bytes) -> np.ndarray:
    x = opened(raw, np.uint64)
    return np.cumsum(x >> np.uint64(32), dtype=np.uint64) << np.uint64(32) | x & np.uint64(0xFFFFFFFF)


class Numbers(dict):
    """Numbers from one on, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


BLOCKS = "block long, docs array<bigint>, lengths binary, good binary, tokens binary, hashes binary, words binary, sizes binary, n_docs long, good_docs long, n_tokens long, good_tokens long"
REQUESTS = "part int, block long, keys binary, sizes binary, counts binary, good binary"
ANSWERS = "part int, block long, ids binary, counts binary, good binary, known long, unknown long, unknown_good long"
SCORES = "doc_id long, n_tokens long, ce_target double, ce_background double, score double"
PARTS = {"block": pa.int64(), "docs": pa.list_(pa.int64()), "part": pa.int32()} | dict.fromkeys(("n_docs", "good_docs", "n_tokens", "good_tokens", "known", "unknown", "unknown_good"), pa.int64())


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], PARTS.get(n, pa.binary())) for k, n in enumerate(names)], names=names)


def flagged(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, text and whether the document is in the target, a table of ids."""
    known = small(target.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct().withColumns({"spot": F.lit(0).cast("long"), "good": F.lit(True)}))
    # rows without an id are spread by their text; their spot is odd, so they find nothing
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumns(
        {"id": F.coalesce("doc_id", F.lit(0)), "spot": F.when(F.col("doc_id").isNull(), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0))}
    )
    return rows.join(known, ["id", "spot"], "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """Texts as numbers, in blocks. rows: as ``flagged`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done = TaskContext.get().partitionId() << 32, 0
        number, docs, good, lengths, tokens = Numbers(), [], [], [], []
        total = 0

        def out() -> pa.RecordBatch:
            words, size, flag = list(number), np.array(lengths, np.uint32), np.array(good, np.uint8)
            hashes, sizes = (np.fromiter(map(f, words), np.uint32, len(words)) for f in (zlib.crc32, len))
            row = (own + done, docs, shut(size), shut(flag), shut(np.concatenate(tokens)), shut(hashes), squeezed(b"".join(words)), shut(sizes), len(docs), int(flag.sum()), int(size.sum()), int(size[flag == 1].sum()))
            return batch_of([row], BLOCKS)

        for piece in pieces(batches):
            flat: list[int] = []
            for text in texts_of(piece):
                before = len(flat)
                flat += map(number.__getitem__, words_in(text))
                flat.append(EDGE)
                lengths.append(len(flat) - before)
            tokens.append(np.array(flat, np.uint32))
            docs += piece.column(0).to_pylist()
            good += piece.column(2).to_pylist()
            total += len(flat)
            if total >= TOKENS:
                yield out()
                number, docs, good, lengths, tokens, total, done = Numbers(), [], [], [], [], 0, done + 1
        if docs:
            yield out()

    return materialize(map_arrow(rows, run, BLOCKS), "blocks")


def listed(raw: bytes, sizes: bytes) -> list[bytes]:
    raw, stops = unsqueezed(raw), np.cumsum(opened(sizes, np.uint32), dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def order_of(part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by part, and for every part that occurs its number and bounds."""
    order = np.argsort(part, kind="stable")
    ordered = part[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(part) else np.zeros(0, np.int64)
    stop = np.append(begin[1:], len(part)) if len(part) else begin
    return order, list(zip(ordered[begin].tolist(), begin.tolist(), stop.tolist(), strict=True))


def mixed(keys: np.ndarray, parts: int) -> np.ndarray:
    x = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(parts)).astype(np.int64)


def good_tokens(r: dict) -> np.ndarray:
    return np.repeat(opened(r["good"], np.uint8) == 1, opened(r["lengths"], np.uint32))


def word_requests(blocks: DataFrame, parts: int) -> DataFrame:
    """The distinct words of every block and their counts, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                words, tokens = listed(r["words"], r["sizes"]), opened(r["tokens"], np.uint32)
                n = np.bincount(tokens, minlength=len(words) + 1)[1:]
                good = np.bincount(tokens[good_tokens(r)], minlength=len(words) + 1)[1:]
                sizes = opened(r["sizes"], np.uint32)
                order, runs = order_of(opened(r["hashes"], np.uint32).astype(np.int64) % parts)
                rows = []
                for part, a, b in runs:
                    at = order[a:b]
                    rows.append((part, r["block"], squeezed(b"".join([words[k] for k in at.tolist()])), shut(sizes[at]), shut(n[at]), shut(good[at])))
                yield batch_of(rows, REQUESTS)

    return map_arrow(blocks.select("block", "lengths", "good", "tokens", "hashes", "words", "sizes"), run, REQUESTS)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows that follow one another and share a key."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if held and held[0][key] != r[key]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def answers(asked: DataFrame, told: DataFrame | None, parts: int, words: bool) -> DataFrame:
    """For every row asked, ids (of words) and counts of its keys, in their order; the counts are sums over ``told`` (``asked`` itself if None)."""
    rows = asked.withColumn("role", F.lit(3))
    if told is not None:
        rows = asked.withColumn("role", F.lit(2)).unionByName(told.withColumn("role", F.lit(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "part"):
            part = group[0]["part"]
            if words:
                number = Numbers()
                places = [np.array([number[w] for w in listed(r["keys"], r["sizes"])], np.int64) - 1 for r in group]
                size = len(number)
            else:
                keys = [opened_keys(r["keys"]) for r in group]
                found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                places, size = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1]), len(found)
            sums = np.zeros((2, size), np.int64)
            for r, place in zip(group, places, strict=True):
                if r["role"] & 1:  # keys of a row are distinct
                    sums[0, place] += opened(r["counts"], np.int64 if words else np.uint32)
                    sums[1, place] += opened(r["good"], np.int64 if words else np.uint32)
            ids, extra = np.zeros(size, np.uint32), (0, 0, 0)
            if words:
                ids[:] = UNKNOWN
                # common words first, whose ids compress best
                known = sorted((w for w, k in number.items() if sums[0, k - 1] >= 2), key=lambda w: (-sums[0, number[w] - 1], w))
                if len(known) * parts + part + FIRST >= 1 << 32:
                    raise OverflowError("more words than ids")
                ids[[number[w] - 1 for w in known]] = np.arange(len(known)) * parts + part + FIRST
                rare = sums[0] == 1
                extra = (len(known), int(rare.sum()), int(sums[1, rare].sum()))
            for r, place in zip(group, places, strict=True):
                if r["role"] & 2:
                    row = (part, r["block"], shut(ids[place]) if words else b"", shut(sums[0, place]), shut(sums[1, place]), *extra)
                    yield batch_of([row], ANSWERS)
                    extra = (0, 0, 0)  # once a part

    return map_arrow(rows.repartition("part").sortWithinPartitions("part"), run, ANSWERS)


@dataclass(frozen=True)
class Totals:
    docs: tuple[int, int]
    tokens: tuple[int, int]
    unknown: tuple[int, int]
    known: int


def coded(group: list[dict], parts: int, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Of a block and its words' answers: the distinct bigrams in the order of parts, each token's bigram, counts of both words of each bigram, bounds of parts."""
    block, found = group[0], [r for r in group if r["kind"] == 1]
    tokens, part = opened(block["tokens"], np.uint32), opened(block["hashes"], np.uint32).astype(np.int64) % parts
    ids, counts = np.full(len(part) + 1, EDGE, np.uint64), np.zeros((2, len(part) + 1))
    order, runs = order_of(part)
    counts[:, EDGE] = totals.docs
    for r, (p, a, b) in zip(found, runs, strict=True):
        assert r["part"] == p
        at = order[a:b] + 1
        ids[at], counts[0, at], counts[1, at] = opened(r["ids"], np.uint32), opened(r["counts"], np.int64), opened(r["more"], np.int64)
    counts[:, ids == UNKNOWN] = np.array(totals.unknown)[:, None]
    before = np.concatenate([[EDGE], tokens[:-1]])
    keys, inverse = np.unique(ids[before] << np.uint64(32) | ids[tokens], return_inverse=True)
    order, runs = order_of(mixed(keys, parts))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    inverse = rank[inverse]
    some = np.empty(len(keys), np.int64)
    some[inverse] = np.arange(len(tokens))
    return keys[order], inverse, counts[:, before[some]], counts[:, tokens[some]], runs


def gathered(blocks: DataFrame, *found: DataFrame) -> DataFrame:
    """Blocks, each followed by its answers in the order of parts."""
    none = lambda kind: F.lit(None).cast(kind)
    rows = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).alias("part"), "docs", "lengths", "good", "tokens", "hashes", *(none("binary").alias(c) for c in ("ids", "counts", "more")))
    for kind, x in enumerate(found, 1):
        rows = rows.unionByName(
            x.select("block", F.lit(kind).alias("kind"), "part", none("array<bigint>").alias("docs"), *(none("binary").alias(c) for c in ("lengths", "good", "tokens", "hashes")), "ids", "counts", F.col("good").alias("more"))
        )
    return rows.repartition("block").sortWithinPartitions("block", "kind", "part")


def pair_requests(blocks: DataFrame, words: DataFrame, parts: int, totals: Totals) -> DataFrame:
    """The distinct bigrams of every block and their counts, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "block"):
            keys, inverse, _, _, runs = coded(group, parts, totals)
            n = np.bincount(inverse, minlength=len(keys)).astype(np.uint32)
            good = np.bincount(inverse[good_tokens(group[0])], minlength=len(keys)).astype(np.uint32)
            yield batch_of([(p, group[0]["block"], shut_keys(keys[a:b]), b"", shut(n[a:b]), shut(good[a:b])) for p, a, b in runs], REQUESTS)

    return map_arrow(gathered(blocks, words), run, REQUESTS)


@dataclass(frozen=True)
class Model:
    """Blocks of the corpus, the answers for their words, and what both models share."""

    docs: DataFrame
    blocks: DataFrame
    words: DataFrame
    parts: int
    totals: Totals


def target_of(labels: DataFrame) -> DataFrame:
    """A table (doc_id) of all documents labelled good."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def target_ids(labels: DataFrame) -> frozenset[int]:
    """The ids of ``target_of`` at the driver, for labels that fit there; the query joins the table."""
    return frozenset(r.doc_id for r in target_of(labels).collect())


def fit(docs: DataFrame, target: DataFrame | frozenset[int]) -> Model:
    """target: a table of ids (doc_id), or few ids as a set."""
    spark = docs.sparkSession
    ids = target if isinstance(target, DataFrame) else spark.createDataFrame([(x,) for x in sorted(target)], "doc_id long")
    blocks = blocks_of(flagged(docs, ids))
    sums = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_docs", "good_docs", "n_tokens", "good_tokens"))).first()
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), sums[2] // TOKENS)
    words = materialize(answers(word_requests(blocks, parts), None, parts, True), "words")
    known, *unknown = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("known", "unknown", "unknown_good"))).first()
    return Model(docs, blocks, words, parts, Totals((sums[0], sums[1]), (sums[2], sums[3]), tuple(unknown), known))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, both cross-entropies (nats a token) and their difference, for every whole text."""
    parts, totals = model.parts, model.totals
    own = pair_requests(model.blocks, model.words, parts, totals)
    if docs is model.docs:
        blocks, words, told, asked = model.blocks, model.words, None, own
    else:
        blocks = blocks_of(flagged(docs, docs.select("doc_id").limit(0)))
        words = materialize(answers(word_requests(blocks, parts), word_requests(model.blocks, parts), parts, True), "words")
        told, asked = own, pair_requests(blocks, words, parts, totals)
    pairs = answers(asked, told, parts, False)
    models = (1 if totals.tokens[1] else 0), 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "block"):
            keys, inverse, histories, words, runs = coded(group, parts, totals)
            found, counts = [r for r in group if r["kind"] == 2], np.zeros((2, len(keys)))
            for r, (p, a, b) in zip(found, runs, strict=True):
                assert r["part"] == p
                counts[:, a:b] = opened(r["counts"], np.int64), opened(r["more"], np.int64)
            lengths = opened(group[0]["lengths"], np.uint32).astype(np.int64)
            place, ce = np.repeat(np.arange(len(lengths)), lengths), []
            for m in models:
                single = (words[m] + 0.5) / (totals.tokens[m] + 0.5 * (totals.known + FIRST))
                loss = -np.log((counts[m] + M * single) / (histories[m] + M))
                ce.append(np.bincount(place, loss[inverse], len(lengths)) / lengths)
            yield pa.RecordBatch.from_arrays([pa.array(group[0]["docs"], pa.int64()), pa.array(lengths - 1), *map(pa.array, (*ce, ce[0] - ce[1]))], names=[x.split()[0] for x in SCORES.split(", ")])

    return map_arrow(gathered(blocks, words, pairs), run, SCORES)
