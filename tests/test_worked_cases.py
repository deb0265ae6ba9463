"""Cases worked by hand, against which neither code nor SQL was written."""

import pytest

from braidlake.operators import aggregates, dedup, graph, nstats, sorting, windows


def molecules(spark, reads, length=500_000):
    rows = spark.createDataFrame([(1, 7, p, i) for p, i in reads], "line long, barcode long, pos long, pair_id long")
    lines = spark.createDataFrame([(1, length)], "line long, length long")
    return [(r.pairs, r.length) for r in windows.molecules(rows, lines).collect()]


def test_molecules_count_the_pairs_after_the_first(spark):
    five = [(100_000 + 1000 * i, i) for i in range(5)]
    assert molecules(spark, five) == [(4, 6666)]  # 5 / 3 * 4000
    assert molecules(spark, five[:4]) == []  # three pairs after the first
    assert molecules(spark, [*five[:4], (104_000, 0)]) == []  # the mate of the first read isn't counted
    assert molecules(spark, five, length=160_000) == []  # too near the line's end


@pytest.mark.parametrize(("values", "want"), [([1, 3, 3, 3, 3], 3), ([10], 5), ([4, 4], 4), ([1, 2, 3, 10], 4), ([2, 6], 3)])
def test_linear_n50(spark, values, want):
    # [1, 2, 3, 10]: half of the sum, 8, lies 2 / 10 of the way from 3 to 10: 4.4. [2, 6]: 4 lies 2 / 6 of the way: 3.3
    rows = nstats.n_linear(spark.createDataFrame([(v,) for v in values], "v long"), "v").collect()
    assert [r.n50pl for r in rows] == [want]


def test_the_upper_of_two_middle_branches_counts(spark):
    rows = spark.createDataFrame([(1, 1, 5), (1, 2, 10), (1, 2, 30), (1, 3, 1), (1, 3, 2), (1, 3, 9)], "line long, cell long, length long")
    assert [tuple(r) for r in aggregates.line_lengths(rows).collect()] == [(1, 5 + 30 + 2)]


def buckets(spark, lengths, **options):
    rows = sorting.balanced_buckets(spark.createDataFrame(list(enumerate(lengths)), "line long, length long"), **options).collect()
    return [r.bucket for r in sorted(rows, key=lambda r: (-r.length, r.line))]


def test_each_bucket_starts_its_sum_anew(spark):
    assert buckets(spark, [600_000] * 6) == [0, 0, 1, 1, 2, 2]
    assert buckets(spark, [5, 4, 4, 3, 3, 3, 1, 0], size=7) == [0, 0, 1, 1, 2, 2, 2, 3]
    assert buckets(spark, [9, 8, 2, 2, 2, 2, 1], size=5, least=2) == [0, 1, 2, 2, 2, 3]
    assert buckets(spark, []) == []


def test_pairs_without_a_barcode_stay(spark):
    rows = [(i, b, "ACGT", "ACGT", [q], [q]) for i, b, q in [(1, 5, 10), (2, 5, 30), (3, None, 1), (4, None, 1), (5, -1, 1), (6, 0, 1), (7, 0, 1)]]
    df = spark.createDataFrame(rows, "pair_id long, barcode long, seq1 string, seq2 string, quals1 array<int>, quals2 array<int>")
    assert sorted(r.pair_id for r in dedup.predup(df).collect()) == [2, 3, 4, 5, 6, 7]


def test_a_long_path_isnt_a_cycle(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    assert not graph.is_cyclic(path)
    assert graph.is_cyclic(path.union(spark.createDataFrame([(30, 28)], "a long, b long")))
