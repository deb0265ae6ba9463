"""Near copies of a five-word similarity of 0.8 or more, by SimHash with pigeonring filtering.

The rule of ``simhash`` (64 bits, at most 4 of them different) reaches near-identical texts only: at a similarity
of 0.8 two SimHashes differ in 15 % of their bits by expectation. So this operator has a rule of its own.

Fingerprint: 512 bits over the distinct five-word shingles of the whole text (A-Z lower-cased; fewer words: the
whole sequence). Bit b of part j is set if it is set in over half of the shingles' XXH64, mixed with j. Fingerprints
link at ``RADIUS`` or fewer differing bits. By expectation that is a similarity of 0.75; pairs of exactly 0.8 lie 10
bits below it, at 1.3 standard deviations.

Candidates: the bits form a ring of 32 segments of 16. A fingerprint is filed under each of its segments, once
for each start. Fingerprints that share a segment are compared from there on: every chain of k consecutive
segments may differ in at most ``BUDGET`` * k / 32 bits, and the check of the whole ring comes last. Starting only
where a whole segment agrees loses pairs, unlike at smaller radii: of pairs of similarity 0.8, 0.85, 0.9 the rule
and the search together link 84, 97 and 99.8 % (binomial model; the tests measure edited texts). ``BUDGET`` is
wider than the radius because a pair has few such starts, and each has to survive. Exact copies are one
fingerprint from the start. Keys have 16 bits whatever the input, so comparisons grow with the square of the
distinct fingerprints, divided by 2**12; all but some 0.1 % of them end after one machine word.

What this loses is found by an exact check that follows (``overlaps``): every pair of texts that the fingerprints
have left in different components is linked if it shares four fifths of its shingles by count. So all pairs of a
similarity of 0.8 or more are linked; the fingerprints' links below 0.8 stay.

Large groups under a key are searched for a spanning forest of their links, never compared pair by pair, and keys
expected to hold more than ``SPLIT`` fingerprints (estimated from a sample of at most ``SAMPLE``) are dealt out over pairs of
blocks. The estimate only decides how work is dealt.

Defined cases: null texts and texts without words have fingerprint zero and are copies of each other. Repeated rows
stay once. An empty table gives an empty result. Very long texts are read whole. Columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.operators import graph
from braidlake.runtime import map_arrow, materialize

from . import overlaps
from .common import columns_of, map_pieces, rows_of, texts_of, with_row
from .simhash import block_pairs

SHINGLE = 5
SEED = 42
SEGMENTS = 32
#: Bytes of a fingerprint: segments of two bytes.
BYTES = 2 * SEGMENTS
RADIUS = 88
BUDGET = 112
#: The segments in the machine word that is compared first.
HEAD = 4
#: Groups up to this size are compared pair by pair, larger ones are searched.
SMALL = 24
SPLIT = 20_000
SAMPLE = 20_000
#: Shingles whose bits are counted at once; partial counts of 255 fit a byte.
BLOCK = 255 * 16

PARTS = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Eight words for each hash, by a finalizer that spreads every bit."""
    x = hashes[:, None] ^ PARTS[None, :]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of the distinct shingles of a text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(joined, SEED)], np.uint64)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-SHINGLE] + 1]).tolist()
    spans = zip(starts, stops[SHINGLE - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts)))


def fingerprint(text: str | None) -> bytes:
    return print_of(shingle_hashes(text))


def print_of(hashes: np.ndarray) -> bytes:
    ones = np.zeros(8 * BYTES, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(mixed(hashes[at : at + BLOCK]).view(np.uint8), axis=1, bitorder="little")
        for row in range(0, len(bits), 255):
            ones += np.add.reduce(bits[row : row + 255], axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def rings(column: pa.Array) -> np.ndarray:
    """A column of fingerprints as rows of segments."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SEGMENTS)


def chained(x: np.ndarray) -> np.ndarray:
    """Whether differences x (rows of segments from a start on) pass ever longer chains, and at last the whole ring."""
    at, spent = np.arange(len(x)), np.zeros(len(x), np.int64)
    for k in range(SEGMENTS):
        spent = spent + np.bitwise_count(x[at, k])
        near = spent <= (BUDGET * (k + 1) // SEGMENTS if k < SEGMENTS - 1 else RADIUS)
        at, spent = at[near], spent[near]
    ok = np.zeros(len(x), bool)
    ok[at] = True
    return ok


def heads(ring: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(ring[:, :HEAD]).view(np.uint64).ravel()


def near(head: np.ndarray, ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs of rows x, y are near: the chain of HEAD segments is tried before the others."""
    ok = np.bitwise_count(head[x] ^ head[y]) <= BUDGET * HEAD // SEGMENTS
    at = np.flatnonzero(ok)
    ok[at] = chained(ring[x[at]] ^ ring[y[at]])
    return ok


def filed(distinct: DataFrame, hot: dict[int, int]) -> DataFrame:
    """For each fingerprint and start a row: the key, the block, the node, and the ring read from the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        busy = np.array(sorted(hot), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                piece = batch.slice(at, 8192)
                nodes, ring = np.asarray(piece.column(0)), rings(piece.column(1))
                for start in range(SEGMENTS):
                    turned = np.roll(ring, -start, axis=1)
                    keys, who, block = ring[:, start].astype(np.int64) | start << 16, np.arange(len(ring)), np.zeros(len(ring), np.int32)
                    if len(busy) and (odd := np.isin(keys, busy)).any():
                        extra = [(i, b) for i in np.flatnonzero(odd).tolist() for b in block_pairs(int(nodes[i]), hot[int(keys[i])])]
                        who = np.concatenate([who[~odd], np.array([i for i, _ in extra], np.int64)])
                        block = np.concatenate([block[~odd], np.array([b for _, b in extra], np.int32)])
                        keys = keys[who]
                    for a in range(0, len(who), 65_536):
                        rows = who[a : a + 65_536]
                        values = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BYTES), len(rows), [None, pa.py_buffer(turned[rows].tobytes())])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[a : a + 65_536]), pa.array(block[a : a + 65_536]), pa.array(nodes[rows]), values.cast(pa.binary())],
                            names=["key", "block", "node", "ring"],
                        )

    return map_arrow(distinct, run, "key long, block int, node long, ring binary")


def hot_keys(distinct: DataFrame) -> dict[int, int]:
    """Keys that a sample expects to hold more than SPLIT fingerprints, and into how many blocks to cut them."""
    total = distinct.count()
    if total <= SPLIT:
        return {}
    every = max(1, -(-total // SAMPLE))
    rows = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").limit(2 * SAMPLE).collect()
    if not rows:
        return {}
    ring = np.frombuffer(b"".join(bytes(r.fp) for r in rows), np.uint16).reshape(-1, SEGMENTS)
    keys, counts = np.unique(ring.astype(np.int64) | np.arange(SEGMENTS) << 16, return_counts=True)
    busy = counts * every > SPLIT
    return {k: -(-c * every // SPLIT) for k, c in zip(keys[busy].tolist(), counts[busy].tolist(), strict=True)}


def forest(head: np.ndarray, ring: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that join what is linked within a group: each row is compared with those not yet reached."""
    left, right = [], []
    rest = np.arange(len(ring))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            found = near(head, ring, np.full(len(rest), x), rest)
            if found.any():
                left.append(np.full(int(found.sum()), x))
                right.append(rest[found])
                queue += rest[found].tolist()
                rest = rest[~found]
    return left, right


def links_of(rows: DataFrame) -> DataFrame:
    """Links (a < b) between nodes that meet under a key; per large group a spanning forest of them."""

    def groups(keys: np.ndarray, blocks: np.ndarray, nodes: np.ndarray, ring: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        head = heads(ring)
        begin = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])) + 1])
        size = np.diff(np.append(begin, len(keys)))
        label, each = np.repeat(np.arange(len(size)), size), np.repeat(size, size)
        some = np.flatnonzero((each > 1) & (each <= SMALL))
        for step in range(1, SMALL):
            x, y = some[:-step], some[step:]
            same = label[x] == label[y]
            if not same.any():
                break
            x, y = x[same], y[same]
            good = near(head, ring, x, y)
            yield nodes[x[good]], nodes[y[good]]
        for g in np.flatnonzero(size > SMALL):
            at = slice(begin[g], begin[g] + size[g])
            for x, y in zip(*forest(head[at], ring[at]), strict=True):
                yield nodes[at][x], nodes[at][y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out(parts: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            for a, b in groups(*parts):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = (*(np.asarray(batch.column(i)) for i in range(3)), rings(batch.column(3)))
            # the last group may go on in the next batch: parts are joined once the group is known to end
            ends = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
            if not len(ends) and held and held[-1][0][-1] == part[0][0] and held[-1][1][-1] == part[1][0]:
                held.append(part)
                continue
            whole = tuple(np.concatenate(x) for x in zip(*held, part, strict=True))
            cut = len(whole[0]) - (len(part[0]) - (ends[-1] + 1 if len(ends) else 0))
            if cut:
                yield from out(tuple(x[:cut] for x in whole))
            held = [tuple(x[cut:] for x in whole)]
        if held:
            yield from out(tuple(np.concatenate(x) for x in zip(*held, strict=True)))

    return map_arrow(rows.repartition("key", "block").sortWithinPartitions("key", "block"), run, "a long, b long")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component of near copies, the one with the smallest doc_id, with all its columns.

    Among rows of that id the least text hash wins; rows equal in both stay once. A component whose ids are all
    null keeps its least text hash.
    """
    keyed = columns_of(docs, doc_id="long", text="string").withColumn("h", F.xxhash64("text"))
    order = overlaps.order_of(keyed, shingle_hashes)
    kinds = {"doc_id": T.LongType(), "h": T.LongType(), "fp": T.BinaryType(), "sig": T.LongType(), "n": T.IntegerType(), "prefix": T.BinaryType(), "bits": T.BinaryType()}

    def rows(piece: pa.RecordBatch) -> dict:
        sets = [shingle_hashes(x) for x in texts_of(piece)]
        held = zip(*(overlaps.columns(x, order) for x in sets), strict=True)
        return {"doc_id": piece.column(0), "h": piece.column(2), "fp": [print_of(x) for x in sets]} | dict(zip(("sig", "n", "prefix", "bits"), map(list, held), strict=True))

    prints = materialize(map_pieces(keyed, rows, T.StructType([T.StructField(*x) for x in kinds.items()])), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "h")).alias("first")
    # the number of a written fingerprint stands for it among the links
    nodes = materialize(prints.groupBy("fp").agg(first).withColumn("node", F.monotonically_increasing_id()), "nodes")
    distinct = nodes.select("node", "fp")
    roots = graph.components(links_of(filed(distinct, hot_keys(distinct))))
    nodes = materialize(nodes.join(roots, "node", "left").select("fp", "first", F.coalesce("root", "node").alias("root")), "roots")
    # the same texts by their sets: what the fingerprints have not joined
    sets = prints.where("n > 0").groupBy("fp", "sig", "n", "prefix", "bits").agg(F.min("h").alias("h"))
    units = materialize(sets.join(nodes.select("fp", "root"), "fp").drop("fp").withColumn("unit", F.monotonically_increasing_id()), "units")
    further = graph.components(overlaps.near_roots(keyed, units, order, shingle_hashes)).select(F.col("node").alias("root"), F.col("root").alias("least"))
    kept = nodes.join(further, "root", "left").groupBy(F.coalesce("least", "root").alias("root")).agg(F.min("first").alias("k"))
    key = ["nil", "id", "hash"]
    kept = kept.select(F.col("k.nil").alias("nil"), F.coalesce("k.doc_id", F.lit(0)).alias("id"), F.col("k.h").alias("hash"))
    # the row travels as one column, so that no name of its own can clash
    named = with_row(docs, doc_id="long", text="string").select("_row", F.col("doc_id").isNull().alias("nil"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    once = Window.partitionBy(*key).orderBy(*key)
    return rows_of(named.join(kept, key, "left_semi").withColumn("n", F.row_number().over(once)).where("n = 1"), docs)
