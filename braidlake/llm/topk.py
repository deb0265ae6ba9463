"""Exact top-k inner products over vectors sorted by length.

Components x become floor(256 * x). Candidates are sorted by descending norm and cut into blocks. A query needs a
block only if its norm times the block's largest reaches the score of its k-th best so far (Cauchy-Schwarz).
Within a block, vectors rotated by an SVD put most of the inner product into the first coordinates: their partial
sum plus the product of the residual norms bounds the score, and only pairs that pass are computed in full, in
integers. Bounds have slack for rounding, so no pair is lost.

Queries and candidates meet in groups of candidate blocks: each candidate block is sent once, to its group's task,
which holds the group (about ``RESIDENT`` bytes, so that the number of groups grows with the table) while the blocks
of queries that may need it stream past, each meeting the longest vectors first. Where a first threshold comes from,
the ``HEAD`` longest vectors, and the rotation, from at most ``SAMPLE`` vectors, is bounded; neither changes a result.

Defined cases: vectors or ids that are null, and vectors with null or non-finite components, take no part. Shorter
vectors count as ending in zeros. All rows with a query's own vec_id count as its own and aren't its candidates;
repeated rows of other ids are candidates each. If a query id repeats, its smallest vector (as bytes) is asked.
Equal scores are ranked by vec_id, in and between groups. Scores beyond 64 bits are clipped to them. Tables with no other row, or none at all, give no row. Columns other
than vec_id and embedding are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.runtime import map_arrow, materialize

from .common import RANGE, columns_of

SCALE = 256
K = 5
EVERY = 50
BLOCK = 2048
QUERY_BLOCK = 1024
HEAD = 2048
SAMPLE = 2048
#: Bytes of vectors that a task holds, as they are and rotated.
RESIDENT = 128 << 20
#: Coordinates in the partial sums, as a share of all.
PARTIAL = 0.25
#: Largest sum of products that doubles hold exactly.
EXACT = float(1 << 53)

PREPARED = "vec_id long, norm double, vec binary"
BLOCKS = "part int, ordinal int, top double, n int, ids binary, norms binary, vecs binary, floors binary"
FOUND = "query_id long, vec_id long, score long"


def prepared(table: DataFrame, dims: int) -> DataFrame:
    """vec_id, norm and scaled vector (doubles that are integers) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                ids, norms, vecs = [], [], []
                part = batch.slice(at, BLOCK)
                column = part.column(1)
                for i, vec_id in enumerate(part.column(0).to_pylist()):
                    values = column[i].values if vec_id is not None and column[i].is_valid else None
                    if values is None or values.null_count:
                        continue
                    x = np.floor(np.asarray(values, np.float64) * SCALE)
                    if not np.isfinite(x).all():
                        continue
                    whole = np.zeros(dims)
                    whole[: len(x)] = x
                    ids.append(vec_id)
                    norms.append(min(float(np.linalg.norm(whole)), 1e300))
                    vecs.append(whole.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(norms, pa.float64()), pa.array(vecs, pa.binary())], names=["vec_id", "norm", "vec"])

    return map_arrow(table.select("vec_id", "embedding"), run, PREPARED)


def matrix(vecs: list[bytes] | bytes, dims: int) -> np.ndarray:
    return np.frombuffer(vecs if isinstance(vecs, bytes) else b"".join(vecs), np.float64).reshape(-1, dims)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows with all rows."""
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])
    if most < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    product = whole(q).dot(whole(c).T)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(x, low), high) for x in row] for row in product], np.int64).reshape(len(q), len(c))


def rotation(sample: np.ndarray, dims: int) -> np.ndarray:
    """An orthogonal matrix whose first columns hold most of the sample's length."""
    if not len(sample):
        return np.eye(dims)
    scaled = sample / max(1.0, float(np.abs(sample).max()))
    return np.linalg.svd(scaled, full_matrices=True)[2].T if len(sample) >= dims else np.linalg.svd(scaled.T @ scaled)[0]


def blocks(rows: DataFrame, size: int, floors: bool = False) -> DataFrame:
    """Rows packed in order, ``size`` to a block. part and ordinal name a block."""
    names = [f.split()[0] for f in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ordinal, held = TaskContext.get().partitionId(), 0, []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            ids, norms, vecs, *more = zip(*rows, strict=True)
            values = [part, ordinal, max(norms), len(ids), np.array(ids, np.int64).tobytes(), np.array(norms).tobytes(), b"".join(vecs), np.array(more[0] if more else [], np.int64).tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held += zip(*(c.to_pylist() for c in batch.slice(at, size).columns), strict=True)
                while len(held) >= size:
                    yield out(held[:size])
                    ordinal, held = ordinal + 1, held[size:]
        if held:
            yield out(held)

    return map_arrow(rows, run, BLOCKS)


LOWEST = -(1 << 63)


class Search:
    """The best candidates so far of a block of queries."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, vecs: np.ndarray, floors: np.ndarray, turn: np.ndarray, k: int):
        self.ids, self.norms, self.vecs, self.k = ids, norms, vecs, k
        self.first = max(1, int(round(PARTIAL * vecs.shape[1]))) if vecs.shape[1] else 0
        self.turned = vecs @ turn
        self.rest = np.linalg.norm(self.turned[:, self.first :], axis=1)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        self.least = floors.copy()

    def see(self, ids: np.ndarray, norms: np.ndarray, vecs: np.ndarray, turned: np.ndarray) -> None:
        """Meet a block of candidates; turned: its vectors rotated."""
        slack = 1 + 1e-9
        least = self.least.astype(np.float64)
        alive = np.flatnonzero(self.norms * norms.max() * slack + 1 >= least)
        if not len(alive):
            return
        rest = np.linalg.norm(turned[:, self.first :], axis=1)
        bound = self.turned[alive, : self.first] @ turned[:, : self.first].T + np.outer(self.rest[alive], rest)
        bound += 1e-9 * np.outer(self.norms[alive], norms) + 1
        passed = (bound >= least[alive, None]) & (self.ids[alive, None] != ids[None, :])
        some = np.flatnonzero(passed.any(axis=0))
        if not len(some):
            return
        exact = scores(self.vecs[alive], vecs[some])
        passed = passed[:, some]
        for row, q in enumerate(alive):
            hit = np.flatnonzero(passed[row] & (exact[row] >= self.least[q]))
            if not len(hit):
                continue
            score = np.concatenate([self.best[q][0], exact[row][hit]])
            who = np.concatenate([self.best[q][1], ids[some][hit]])
            order = np.lexsort((who, -score.astype(object) if score.min() == LOWEST else -score))[: self.k]
            self.best[q] = score[order], who[order]
            if len(order) == self.k:
                self.least[q] = max(self.least[q], score[order][-1])


def search(table: DataFrame, is_query: Column | None = None, k: int = K, groups: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best. is_query: by default ids divisible by 50."""
    spark, table = table.sparkSession, columns_of(table, vec_id="long", embedding="array<double>")
    is_query = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    dims = table.agg(F.max(F.size("embedding"))).first()[0]
    dims = max(0, dims or 0)
    rows = materialize(prepared(table, dims), "vectors")
    total = rows.count()
    groups = groups or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK)), -(-total * 16 * dims // RESIDENT))
    # vec_id takes part in the order, so that equal norms spread over several groups
    candidates = materialize(blocks(rows.repartitionByRange(groups, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id"), BLOCK), "blocks")
    # one number a group: how many there are is set above
    tops = sorted(tuple(r) for r in candidates.groupBy("part").agg(F.max("top")).collect())
    head = candidates.where((F.col("part") == (tops[0][0] if tops else -1)) & (F.col("ordinal") < max(1, HEAD // BLOCK))).collect()
    head_ids = np.concatenate([np.frombuffer(bytes(r.ids), np.int64) for r in head]) if head else np.empty(0, np.int64)
    head_vecs = matrix(b"".join(bytes(r.vecs) for r in head), dims) if dims else np.zeros((len(head_ids), 0))
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(RANGE))
    sample = rows.where(hashed < min(RANGE, RANGE * 2 * SAMPLE // max(1, total))).select("vec").limit(SAMPLE).collect()
    turn = rotation(matrix([bytes(r.vec) for r in sample], dims), dims) if dims else np.eye(0)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th best score that the longest vectors alone give each query."""
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                ids, vecs = np.asarray(part.column(0)), matrix(part.column(2).to_pylist(), dims) if dims else np.zeros((part.num_rows, 0))
                got = np.where(ids[:, None] != head_ids[None, :], scores(vecs, head_vecs), LOWEST)
                least = np.partition(got, got.shape[1] - k, axis=1)[:, -k] if got.shape[1] >= k else np.full(len(ids), LOWEST)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least)], names=["vec_id", "norm", "vec", "floor"])

    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("vec", "norm")).alias("v")).select("vec_id", "v.norm", "v.vec")
    asked = materialize(map_arrow(asked, floors, PREPARED + ", floor long"), "queries")
    n_asked = asked.count()
    queries = materialize(blocks(asked.repartition(max(1, -(-n_asked // QUERY_BLOCK)), F.xxhash64("vec_id")), QUERY_BLOCK), "query-blocks")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for part, ordinal, norms, least in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                norms, least = np.frombuffer(norms), np.frombuffer(least, np.int64).astype(np.float64)
                for group, top in tops:
                    if (norms * top * (1 + 1e-9) + 1 >= least).any():
                        for column, value in zip(out, (part, ordinal, group), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in out], names=["q_part", "q_ordinal", "group"])

    pairs = materialize(map_arrow(queries.select("part", "ordinal", "norms", "floors"), needed, "q_part int, q_ordinal int, group int"), "pairs")
    key = ["group"]
    met = shipped(pairs, queries, candidates).repartition(groups, *key).sortWithinPartitions(*key, "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                own, at = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                if own != group:
                    group, held = own, []
                ids, norms, vecs, least = (batch.column(i)[row].as_py() for i in range(2, 6))
                ids, norms = np.frombuffer(ids, np.int64), np.frombuffer(norms)
                vecs = matrix(vecs, dims) if dims else np.zeros((len(ids), 0))
                if at < 0:
                    held.append((ids, norms, vecs, vecs @ turn))
                    continue
                state = Search(ids, norms, vecs, np.frombuffer(least, np.int64), turn, k)
                for block in held:
                    state.see(*block)
                found = [(q, v, s) for q, (ss, vs) in zip(state.ids.tolist(), state.best, strict=True) for s, v in zip(ss.tolist(), vs.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return map_arrow(met, run, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def shipped(pairs: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """What is sent to each group: its candidate blocks, once (at below 0, the longest vectors first), and the blocks of queries that need it."""
    payload = ["ids", "norms", "vecs", "floors"]
    asked = pairs.join(queries, (F.col("q_part") == F.col("part")) & (F.col("q_ordinal") == F.col("ordinal"))).select("group", F.lit(0).alias("at"), *payload)
    needed = pairs.select("group").distinct()
    held = candidates.join(needed, F.col("group") == F.col("part")).select("group", (F.col("ordinal") - (1 << 30)).alias("at"), *payload)
    return held.unionByName(asked)
