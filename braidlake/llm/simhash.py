"""SimHash near duplicates, with candidates found by pigeonring filtering.

Fingerprint: words of the text with A-Z lower-cased, 4-word shingles joined by spaces (fewer words: the whole
sequence), XXH64 with seed 42 of each occurrence; a bit is 1 if set in over half of the hashes. Texts without
words have fingerprint zero, which links like any other.

Candidates: the 64 bits form a ring of five segments. If two fingerprints differ in at most 4 bits, then from
some segment on every chain of k consecutive segments differs in at most 4k/5 bits, rounded down: 0, 1, 2, 3, 4.
So they agree in that segment and differ in at most one bit of the next. Each distinct fingerprint is filed
under those 26 bits from each of the five starts, once as it is (the probe) and once for every single change of
the second segment's bits; only those that meet under a key are compared: chains of one to four segments prune, and
the check of all bits, a chain of five, comes last for what they leave. Keys have 26 bits whatever the input, so
comparisons grow with the square of the distinct fingerprints, divided by 2**26.

Exact copies are one fingerprint from the start. Under a key, large groups are not compared pair by pair: a
search visits each fingerprint once and gives a spanning forest of the links. A key estimated (from a sample of
at most ``SAMPLE`` fingerprints) to hold more than ``SPLIT`` fingerprints is dealt out over pairs of blocks.
The estimate only decides how work is dealt; links never depend on it. Components are found by alternating
large and small stars, each round written to the shared folder.

Defined cases: null or empty texts have fingerprint zero. Repeated rows stay rows of their own. An empty table
gives an empty result. If all ids of a component are null, its component_id is null. Columns other than doc_id
and text are ignored, whatever their names. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.operators import graph
from braidlake.runtime import map_arrow, materialize

from .common import columns_of, map_pieces, texts_of

SHINGLE = 4
SEED = 42
MAX_BITS = 4
WIDTHS = (13, 13, 13, 13, 12)
STARTS = np.concatenate([[0], np.cumsum(WIDTHS)[:-1]]).astype(np.uint64)
#: A key expected to hold more fingerprints than this is dealt out over block pairs.
SPLIT = 20_000
SAMPLE = 50_000
#: Groups up to this size are compared pair by pair, larger ones are searched.
SMALL = 24


def fingerprint(text: str | None) -> int:
    """The 64 bits of a text, as a signed integer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], stops[: -SHINGLE] + 1]).tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (a signed long) of every whole text."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    return map_pieces(
        columns_of(docs, doc_id="long", text="string"),
        lambda piece: {"doc_id": piece.column(0), "fp": [fingerprint(x) for x in texts_of(piece)]},
        schema,
    )


def turned(fp: np.ndarray, start: int) -> np.ndarray:
    """The ring read from a segment on: that segment's bits are lowest."""
    s = STARTS[start]
    return fp if s == 0 else (fp >> s) | (fp << (np.uint64(64) - s))


def keys_of(fps: np.ndarray, start: int) -> np.ndarray:
    """For each fingerprint its probe key and, after it, those with one bit of the second segment changed."""
    first, second = WIDTHS[start], WIDTHS[(start + 1) % 5]
    plain = turned(fps, start) & np.uint64((1 << (first + second)) - 1)
    flips = np.concatenate([[0], 1 << np.arange(first, first + second, dtype=np.int64)]).astype(np.uint64)
    return (plain[:, None] ^ flips[None, :]) | np.uint64(start << 26)


def chained(x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Whether differences x pass ever longer chains from a start, of which the last is the full check."""
    ok = np.zeros(x.shape, bool)
    starts = np.broadcast_to(np.asarray(start), x.shape)
    for s in np.unique(starts).tolist():
        at, width = np.flatnonzero(starts == s), 0
        y = turned(x[at], s)
        for k in range(5):
            width += WIDTHS[(s + k) % 5]
            near = np.bitwise_count(y & np.uint64((1 << width) - 1)) <= MAX_BITS * (k + 1) // 5
            at, y = at[near], y[near]
        ok[at] = True
    return ok


def filed(distinct: DataFrame, hot: dict[int, int]) -> DataFrame:
    """A row for each key of each fingerprint. hot: keys that are dealt over block pairs, and their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        busy = np.array(sorted(hot), np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = np.asarray(batch.column(0).slice(at, 4096)).view(np.uint64)
                for start in range(5):
                    keys = keys_of(fps, start)
                    probe = np.zeros(keys.shape, bool)
                    probe[:, 0] = True
                    who = np.broadcast_to(fps[:, None], keys.shape).ravel()
                    keys, probe, block = keys.ravel(), probe.ravel(), np.zeros(keys.size, np.int32)
                    if len(busy) and (odd := np.isin(keys, busy)).any():
                        extra = [(k, f, p, b) for k, f, p in zip(keys[odd].tolist(), who[odd].tolist(), probe[odd].tolist(), strict=True) for b in block_pairs(f, hot[k])]
                        keys = np.concatenate([keys[~odd], np.array([x[0] for x in extra], np.uint64)])
                        who = np.concatenate([who[~odd], np.array([x[1] for x in extra], np.uint64)])
                        probe = np.concatenate([probe[~odd], np.array([x[2] for x in extra], bool)])
                        block = np.concatenate([block[~odd], np.array([x[3] for x in extra], np.int32)])
                    # the probe's flag is the lowest bit
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys << np.uint64(1) | probe).view(np.int64)), pa.array(block), pa.array(who.view(np.int64))], names=["key", "block", "fp"]
                    )

    return map_arrow(distinct, run, "key long, block int, fp long")


def block_pairs(fp: int, blocks: int) -> list[int]:
    """The pairs of blocks, as numbers, in which a fingerprint takes part; any two meet in one of them."""
    own = (fp * 0x9E3779B97F4A7C15 >> 20) % blocks
    return [min(own, b) * blocks + max(own, b) for b in range(blocks)]


def hot_keys(distinct: DataFrame) -> dict[int, int]:
    """Keys that the sample expects to hold more than SPLIT fingerprints, and into how many blocks to cut them."""
    total = distinct.count()
    if total <= SPLIT:
        return {}
    every = max(1, -(-total // SAMPLE))
    rows = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).limit(2 * SAMPLE).collect()
    fps = np.array([r.fp for r in rows], np.int64).view(np.uint64)
    if not len(fps):
        return {}
    found = {}
    for start in range(5):
        keys, counts = np.unique(keys_of(fps, start).ravel(), return_counts=True)
        for k, c in zip(keys[counts * every > SPLIT].tolist(), counts[counts * every > SPLIT].tolist(), strict=True):
            found[k] = -(-c * every // SPLIT)
    return found


def forest(fps: np.ndarray, start: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that join what is linked within a group: each fingerprint is compared with those not yet reached."""
    left, right = [], []
    rest = np.unique(fps)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = chained(rest ^ x, start)
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), x))
                right.append(found)
                queue += list(found)
                rest = rest[~near]
    return left, right


def links_of(rows: DataFrame) -> DataFrame:
    """Links (a < b) between fingerprints that meet under a key; per large group a spanning forest of them."""

    def groups(keys: np.ndarray, blocks: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        plain = keys >> np.uint64(1)
        new = np.flatnonzero((plain[1:] != plain[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        begin = np.concatenate([[0], new])
        size = np.diff(np.append(begin, len(keys)))
        probes = np.add.reduceat(keys & np.uint64(1), begin)
        big = (size > SMALL) & (probes > 0)
        label = np.repeat(np.arange(len(size)), size)
        some = np.repeat((size > 1) & (size <= SMALL) & (probes > 0), size)
        label, k, f = label[some], keys[some], fps[some]
        starts = (k >> np.uint64(27)).astype(np.int64)
        for step in range(1, SMALL):
            if len(label) <= step:
                break
            same = np.flatnonzero((label[step:] == label[:-step]) & (((k[step:] | k[:-step]) & np.uint64(1)) == 1) & (f[step:] != f[:-step]))
            if not len(same) and not (label[step:] == label[:-step]).any():
                break
            x = f[same] ^ f[same + step]
            good = same[chained(x, starts[same])]
            yield f[good], f[good + step]
        for g in np.flatnonzero(big):
            at = slice(begin[g], begin[g] + size[g])
            for pair in zip(*forest(fps[at], int(plain[begin[g]] >> np.uint64(26))), strict=True):
                yield pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out(parts: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            for a, b in groups(*parts):
                if len(a):
                    a, b = a.view(np.int64), b.view(np.int64)
                    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, blocks, fps = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1)), np.asarray(batch.column(2)).view(np.uint64)
            whole = tuple(np.concatenate(x) for x in zip(*held, (keys, blocks, fps), strict=True))
            # the last group may go on in the next batch
            last = np.flatnonzero((whole[0] >> np.uint64(1) != whole[0][-1] >> np.uint64(1)) | (whole[1] != whole[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield from out(tuple(x[:cut] for x in whole))
            held = [tuple(x[cut:] for x in whole)]
        if held:
            yield from out(tuple(np.concatenate(x) for x in zip(*held, strict=True)))

    plain = F.shiftright("key", 1)
    return map_arrow(rows.repartition(plain, "block").sortWithinPartitions(plain, "block"), run, "a long, b long")


def classes(prints: DataFrame) -> DataFrame:
    """fp, root and first for every distinct fingerprint; prints has doc_id, h and fp.

    root names the component; first is its first document as (id is null, doc_id, h), which are compared in that order.
    """
    firsts = materialize(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "h")).alias("first")), "firsts")
    distinct = firsts.select("fp")
    roots = graph.components(links_of(filed(distinct, hot_keys(distinct))))
    joined = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = materialize(joined, "roots")
    return joined.select("fp", "root").join(joined.groupBy("root").agg(F.min("first").alias("first")), "root")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (its smallest doc_id) of every document."""
    prints = materialize(fingerprints(docs), "prints")
    found = classes(prints.withColumn("h", F.lit(0).cast("long"))).select("fp", F.col("first.doc_id").alias("component_id"))
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
