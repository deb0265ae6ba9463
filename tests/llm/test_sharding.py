import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from braidlake.llm import sharding


def brute_capacity(sizes, shards):
    """Least largest sum over all contiguous partitions."""
    best = {0: 0}
    for _ in range(shards):
        after = dict(best)
        for i, worst in best.items():
            for j in range(i + 1, len(sizes) + 1):
                after[j] = min(after.get(j, 1 << 60), max(worst, sum(sizes[i:j])))
        best = after
    return best[len(sizes)]


@given(st.lists(st.integers(1, 50), min_size=1, max_size=14), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_minimax_against_all_partitions(sizes, shards):
    sizes = np.array(sizes)
    assert sharding.smallest_capacity(sizes, shards) == brute_capacity(sizes.tolist(), shards)
    begins = sharding.cuts(sizes, shards)
    assert begins[0] == 0 and begins[-1] == len(sizes) and (np.diff(begins) >= 0).all() and len(begins) == shards + 1
    assert max(sizes[a:b].sum() for a, b in zip(begins, begins[1:], strict=False)) == brute_capacity(sizes.tolist(), shards)


def test_a_large_group_leaves_the_rest_even():
    sizes = np.array([10] * 300 + [1000] + [10] * 300)
    begins = sharding.cuts(sizes, 20)
    weights = [int(sizes[a:b].sum()) for a, b in zip(begins, begins[1:], strict=False)]
    # the shard that ends where the large group begins may be smaller; all others are even
    assert max(weights) == 1000 and sorted(weights)[-2] <= 400 and sorted(weights)[1] >= 280
    assert sharding.cuts(np.array([5, 5]), 4).tolist() == [0, 1, 2, 2, 2]


def check(df, rows):
    texts = sorted(((r.doc_id, (r.text or "").encode()) for r in df.collect()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(((i, len(t) + 16, zlib.crc32(t)) for i, t in texts), key=repr)
    slots, weight, where = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < 40 and r.grown_shard is None
        slots[r.shard].append(r.slot)
        weight[r.shard] += r.size
        where[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight, where


def test_query_on_documents(documents):
    rows = sharding.shard(documents).collect()
    weight, where = check(documents, rows)
    assert all(len(s) == 1 for s in where.values())
    assert max(weight.values()) == brute_minimax(documents, 40)
    again = sharding.shard(documents.repartition(5)).collect()
    assert sorted((r.doc_id, r.shard) for r in rows) == sorted((r.doc_id, r.shard) for r in again)


def brute_minimax(df, shards):
    """The least largest shard over groups of equal texts, by filling greedily at every capacity in turn."""
    groups = df.groupBy(F.xxhash64(F.col("text").isNull(), "text").alias("h")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("n"))
    sizes = [r.n for r in groups.orderBy("h").collect()]

    def needed(capacity):
        count, room = 1, capacity
        for n in sizes:
            count, room = (count, room - n) if n <= room else (count + 1, capacity - n)
        return count

    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while needed(capacity) > shards:
        capacity += 1
    return capacity


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_blocks_are_refined_to_the_exact_minimax(spark, documents, monkeypatch, bits):
    monkeypatch.setattr(sharding, "CELL_BITS", bits)
    monkeypatch.setattr(sharding, "FINER", 2)
    weight, _ = check(documents, sharding.shard(documents).collect())
    assert max(weight.values()) == brute_minimax(documents, 40)


def test_awkward_rows(awkward, empty):
    check(awkward, sharding.shard(awkward).collect())
    assert sharding.shard(empty).count() == 0
