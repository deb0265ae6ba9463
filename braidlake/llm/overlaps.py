"""All pairs of shingle sets with a Jaccard similarity of 0.8 or more: prefix filtering, then an exact count.

Sets are the hashes of a text's distinct shingles. Two sets of similarity 0.8 share four fifths of either, so each
has one of the shared shingles among any n - ceil(0.8 n) + 1 of its own that come first in one order of all
shingles. Texts that meet under such a shingle are a candidate if their sizes (5 min >= 4 max) and the places of
that shingle allow the overlap 4 (n + m) / 9. The order is by how often a sample of texts holds the shingle, rare
ones first, then by hash: passages that many texts share come last. The sample decides the order and how
work is dealt, never the result; a shingle of very many texts is dealt out over pairs of blocks.

A candidate then has to pass bitmaps of its sets (a bit of one that the other lacks is a shingle it lacks), and at
last the whole sets are intersected. Nothing is estimated: no pair of 0.8 is lost, none below is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.operators.joins import small
from braidlake.runtime import map_arrow, materialize

from .common import pieces, texts_of
from .simhash import block_pairs

#: Texts in the sample at least (all, if fewer), and one of how many is sampled at most: a sample of a fixed size would
#: see ever less of what many texts share, and candidates would grow with the square of the texts.
SAMPLE, EVERY = 8_000, 8
#: Shingles that count as frequent at most; all tasks hold them.
FREQUENT = 400_000
#: A shingle expected in the prefixes of more texts than this is dealt out over block pairs.
SPLIT = 20_000
#: Groups up to this size are compared row by row at a distance, larger ones each row with the rest.
SMALL = 24
#: Bits of a set's map: a power of two of at least its size within these.
LEAST_BITS, MOST_BITS = 512, 1 << 16

Hashes = Callable[[str | None], np.ndarray]


class Order:
    """Frequent shingles of a sample: tokens (sorted), how many sampled texts hold each, one of how many texts is sampled."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, every: int):
        self.tokens, self.counts, self.every = tokens, counts, every

    def counted(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
        return np.where(self.tokens[at] == hashes, self.counts[at], 0)

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        """The shingles of a set of which a set of similarity 0.8 has one, in order."""
        return hashes[np.lexsort((hashes, self.counted(hashes)))][: len(hashes) - (4 * len(hashes) + 4) // 5 + 1] if len(hashes) else hashes

    def hot(self) -> dict[int, int]:
        """Shingles that are dealt over blocks, and into how many."""
        busy = self.counts * self.every > SPLIT
        return {t: -(-c * self.every // SPLIT) for t, c in zip(self.tokens[busy].tolist(), self.counts[busy].tolist(), strict=True)}


def order_of(keyed: DataFrame, hashes: Hashes) -> Order:
    """keyed: text and its hash h."""
    every = min(EVERY, max(1, -(-keyed.count() // SAMPLE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            for text in texts_of(piece):
                if len(found := hashes(text)):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["token"])

    sampled = keyed.where(F.pmod("h", F.lit(every)) == 0).select("h", "text").dropDuplicates(["h"]).select("text")
    counts = materialize(map_arrow(sampled, run, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    least, held = 2, 0
    for n, tokens in sorted(((r[0], r[1]) for r in counts.groupBy("n").agg(F.count("*")).collect()), reverse=True):
        if (held := held + tokens) > FREQUENT:
            least = n + 1
            break
    rows = counts.where(F.col("n") >= least).toArrow()
    tokens, n = rows.column("token").to_numpy().astype(np.int64).view(np.uint64), rows.column("n").to_numpy().astype(np.int64)
    at = np.argsort(tokens)
    return Order(tokens[at], n[at], every)


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each shingle, by the lowest bits of its hash."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, len(hashes)) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[hashes & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def allowed(x: bytes, y: bytes, n: int, m: int) -> bool:
    """Whether bitmaps leave two sets of n and m shingles the overlap that 0.8 needs; the longer map is folded first."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    need = -(-4 * (n + m) // 9)
    return n - int(np.bitwise_count(a & ~b).sum()) >= need and m - int(np.bitwise_count(b & ~a).sum()) >= need


def columns(hashes: np.ndarray, order: Order) -> tuple[int, int, bytes, bytes]:
    """What a text's row carries: a hash and the size of its set, its prefix and its bitmap."""
    sig = int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), 7), np.uint64).view(np.int64))
    return sig, len(hashes), order.prefix(hashes).tobytes(), bitmap(hashes)


def filed(units: DataFrame, hot: dict[int, int]) -> DataFrame:
    """A row for each shingle of each prefix. size: the set's size, and below it in the low 32 bits the shingle's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        busy = np.array(sorted(hot), np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                unit, root, n = (np.asarray(piece.column(i)) for i in range(3))
                parts = [np.frombuffer(x, np.uint64) for x in piece.column(3).to_pylist()]
                lengths = np.array([len(x) for x in parts])
                tokens, who = np.concatenate(parts), np.repeat(np.arange(len(parts)), lengths)
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                block = np.zeros(len(tokens), np.int32)
                if len(busy) and (odd := np.isin(tokens, busy)).any():
                    extra = [(i, b) for i in np.flatnonzero(odd).tolist() for b in block_pairs(int(unit[who[i]]), hot[int(tokens[i])])]
                    rows = np.concatenate([np.flatnonzero(~odd), np.array([i for i, _ in extra], np.int64)])
                    block = np.concatenate([block[~odd], np.array([b for _, b in extra], np.int32)])
                    tokens, who, place = tokens[rows], who[rows], place[rows]
                for a in range(0, len(tokens), 65_536):
                    s = slice(a, a + 65_536)
                    w = who[s]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tokens[s].view(np.int64)), pa.array(block[s]), pa.array(unit[w]), pa.array(root[w]), pa.array(n[w].astype(np.int64) << 32 | place[s])],
                        names=["token", "block", "unit", "root", "size"],
                    )

    return map_arrow(units.select("unit", "root", "n", "prefix"), run, "token long, block int, unit long, root long, size long")


def may(root: np.ndarray, size: np.ndarray, x, y) -> np.ndarray:
    """Which rows x, y that share a shingle have different roots, and sizes and places that allow 0.8."""
    n, m, p, q = size[x] >> 32, size[y] >> 32, size[x] & 0xFFFFFFFF, size[y] & 0xFFFFFFFF
    near = (root[x] != root[y]) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
    return near & (9 * np.minimum(n - p, m - q) >= 4 * (n + m))


def candidates(rows: DataFrame) -> DataFrame:
    """a < b of all pairs of units with different roots that meet under a shingle and may be near."""

    def groups(token: np.ndarray, block: np.ndarray, unit: np.ndarray, root: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        begin = np.concatenate([[0], np.flatnonzero((token[1:] != token[:-1]) | (block[1:] != block[:-1])) + 1])
        count = np.diff(np.append(begin, len(token)))
        label, each = np.repeat(np.arange(len(count)), count), np.repeat(count, count)
        some = np.flatnonzero((each > 1) & (each <= SMALL))
        for step in range(1, SMALL):
            x, y = some[:-step], some[step:]
            same = label[x] == label[y]
            if not same.any():
                break
            x, y = x[same], y[same]
            good = may(root, size, x, y)
            yield unit[x[good]], unit[y[good]]
        for g in np.flatnonzero(count > SMALL):
            at = np.arange(begin[g], begin[g] + count[g])
            if (root[at] == root[at[0]]).all():
                continue
            for i in range(len(at) - 1):
                y = at[i + 1 :]
                good = y[may(root, size, np.full(len(y), at[i]), y)]
                if len(good):
                    yield np.full(len(good), unit[at[i]]), unit[good]

    def out(parts: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        for a, b in groups(*parts):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(np.asarray(batch.column(i)) for i in range(5))
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

    return map_arrow(rows.repartition("token", "block").sortWithinPartitions("token", "block"), run, "a long, b long").distinct()


def mapped(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """The candidates a, b that pass the bitmaps."""
    side = lambda x: units.select(F.col("unit").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            yield batch.select(["a", "b"]).filter(pa.array([allowed(*z) for z in zip(x, y, n, m, strict=True)], pa.bool_()))

    return map_arrow(joined, run, "a long, b long")


def near_roots(keyed: DataFrame, units: DataFrame, order: Order, hashes: Hashes) -> DataFrame:
    """Links a, b between different roots that hold two texts of similarity 0.8 or more.

    units, written: unit, root, n, prefix, bits of every distinct set, and sig and h of it and of a text that has it.
    keyed: text and h. Only texts of candidates that the bitmaps leave are read again, for their whole sets.
    """
    pairs = materialize(mapped(materialize(candidates(filed(units, order.hot())), "candidates"), units), "candidates")
    named = pairs.select(F.col("a").alias("unit")).union(pairs.select("b")).distinct()
    wanted = materialize(units.join(small(named), "unit", "left_semi").select("unit", "root", "h", "sig"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = [hashes(x) for x in texts_of(piece)]
            sigs = [columns(x, Order(x[:0], x[:0], 1))[0] for x in sets]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sigs, pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["h", "sig", "shingles"])

    texts = keyed.join(small(wanted.select("h").distinct()), "h", "left_semi").select("h", "text").dropDuplicates(["h"])
    sets = materialize(map_arrow(texts, run, "h long, sig long, shingles binary").join(wanted, ["h", "sig"]).select("unit", "root", "shingles"), "sets")
    side = lambda x: sets.select(*(F.col(c).alias(x if c == "unit" else f"{c}_{x}") for c in sets.columns))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("root_a", "root_b", "shingles_a", "shingles_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                near = []
                for x, y in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True):
                    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    near.append(9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b)))
                kept = piece.select([0, 1]).filter(pa.array(near, pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, names=["a", "b"])

    return map_arrow(joined, check, "a long, b long").distinct()
