from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from braidlake.llm import mixing

from .conftest import brute_words


def brute_targets(sizes):
    """Resharing by weight until no source is above its ceiling. sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in fixed]
        rest, weights = total - sum(fixed.values()), sum(weight[s] for s in left)
        share = {s: rest * weight[s] / weights for s in left}
        above = [s for s in left if share[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def check(df, rows, near):
    want = sorted((r.doc_id, r.source, len(brute_words(r.text))) for r in df.collect() if r.doc_id is not None)
    assert sorted((r.doc_id, r.source, r.size) for r in rows if r.doc_id is not None) == want
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    targets = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        epochs = min(3, int((r.target + 1e-9) // max(1, r.source_size)))
        assert r.taken >= (epochs - (abs(r.target / max(1, r.source_size) - epochs) < 1e-9)) * r.size
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= near * targets[s] + 60, (s, taken[s], targets[s])


def brute_taken(df):
    """Words taken of each row (doc_id, source), document by document in the order of keys."""
    rows = mixing.keyed(df.select("doc_id", "source", "text")).select("doc_id", "source", "_size", "_key", "_tie").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r._size
    out = []
    for source, target in brute_targets(sizes).items():
        own = [r for r in rows if r.source == source]
        epochs = min(3, int(target / sizes[source])) if sizes[source] else 0
        gap, at, taken = target - epochs * sizes[source], 0, set()
        keys = sorted({(r._key, r._tie) for r in own if r._size})
        words = {k: sum(r._size for r in own if (r._key, r._tie) == k) for k in keys}
        while at < len(keys) and words[keys[at]] <= gap:
            gap -= words[keys[at]]
            taken.add(keys[at])
            at += 1
        tried = keys[at : at + mixing.TRIED]
        for k in tried:
            if words[k] <= gap:
                gap -= words[k]
                taken.add(k)
        taken |= set([k for k in tried if k not in taken and words[k] < 2 * gap][:1])
        out += [(r.doc_id, r.source, r._size * (epochs + ((r._key, r._tie) in taken))) for r in own]
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["documents", "awkward"])
def test_which_documents_are_taken(request, which):
    df = request.getfixturevalue(which)
    got = sorted(((r.doc_id, r.source, r.taken) for r in mixing.mix(df).collect()), key=repr)
    assert got == brute_taken(df)


def test_bins_follow_the_weighted_keys(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'s' AS source", "'12 345 6789' AS text")
    most = mixing.keyed(df).groupBy(mixing.binned(F.col("_key")).alias("b")).count().agg(F.max("count")).first()[0]
    assert most < 50


def test_targets_and_epochs(spark):
    data = [(i, "w " * (1 + i % 9), f"s{min(i // 7, 6)}") for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    check(df, rows, 0.01)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_ceiling_is_reshared(spark):
    data = [(i, "w " * 10, "a") for i in range(3)] + [(100 + i, "w " * 10, "b") for i in range(200)] + [(900, "w", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    check(df, rows, 0.01)
    assert {r.taken for r in rows if r.source == "a"} == {30}


def test_query_on_documents(documents):
    check(documents, mixing.mix(documents).collect(), 0.3)


def test_awkward_rows(awkward, empty):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (300, 301, 302))
    assert {r.target for r in rows if r.source is None} == {0.0}
    mixed = mixing.apply(awkward)
    assert mixed.columns == awkward.columns
    assert sum(len(brute_words(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.apply(empty).count() == 0
