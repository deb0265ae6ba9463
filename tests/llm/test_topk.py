import random

import numpy as np
import pytest

from braidlake.llm import topk


def brute(rows, k=5):
    good = []
    for i, x in rows:
        if i is not None and x is not None and all(v is not None and np.isfinite(v) for v in x):
            good.append((i, [int(np.floor(256 * float(v))) for v in x]))
    asked = {}
    for i, x in sorted(good, key=lambda r: (r[0], np.array(r[1], float).tobytes())):
        if i % 50 == 0:
            asked.setdefault(i, x)
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    out = []
    for i, q in asked.items():
        found = sorted((-clip(sum(a * b for a, b in zip(q, x))), j) for j, x in good if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(3)
    return sorted(map(tuple, topk.search(df, **options).collect()))


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e12])
def test_random_vectors_with_ties(spark, scale):
    rng = random.Random(int(scale) % 97)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(8)]) for i in range(160)]
    rows += [(200 + i, rows[7][1]) for i in range(10)] + [rows[3], rows[0]]
    assert run(spark, rows, groups=3) == brute(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (1, [inf, 0.0]), (2, [1.0, None]), (3, [5.0]), (4, [0.0, 0.0]), (None, [9.0, 9.0]), (150, [1.0, 1.0, 1.0]), (5, []), (200, [])]
    assert run(spark, rows) == brute([(i, x) for i, x in rows])
    assert run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "HEAD", 32)
    vecs = rng.normal(size=(400, 6)) * rng.exponential(size=(400, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    assert run(spark, rows, groups=4) == brute(rows)


def test_candidate_blocks_are_sent_once(spark, monkeypatch):
    rng, sent = np.random.default_rng(4), []
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    whole = topk.shipped
    monkeypatch.setattr(topk, "shipped", lambda *parts: sent.append((parts, whole(*parts))) or sent[0][1])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1000, 6)))]
    assert run(spark, rows, groups=4) == brute(rows)
    (pairs, queries, candidates), df = sent[0]
    assert queries.count() >= 10
    needed = {r.group for r in pairs.select("group").distinct().collect()}
    assert df.where("at < 0").count() == candidates.where(candidates["part"].isin(needed)).count() == df.where("at < 0").select("group", "at").distinct().count()


def test_query_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert sorted(map(tuple, topk.search(df).collect())) == brute([(r.vec_id, r.embedding) for r in df.collect()])
