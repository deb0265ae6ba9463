import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from braidlake.functions import numeric, ranges, sequence
from braidlake.operators import aggregates, dedup, graph, intervals, joins, kmers, nstats, sets, sorting, windows
from braidlake.plans import catalog


def one(spark, *columns, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(*columns).first()


# functions


def test_sequence_functions(spark):
    r = one(
        spark,
        sequence.reverse_complement(F.lit("aCGTn")),
        sequence.canonical(F.lit("TTG")),
        sequence.is_reverse(F.lit("AT")),
        sequence.barcode_id(F.lit("1_2_3")),
        sequence.barcode_id(F.lit("0_0_0")),
        sequence.unpack(sequence.pack(F.lit("ACTGG")), 5),
        F.size(sequence.kmers(F.lit("ACG"), 4)),
        sequence.wrap(F.lit("ACGTA"), 2),
        sequence.iupac_letter(sequence.iupac_bits(F.lit("A")).bitwiseOR(sequence.iupac_bits(F.lit("g")))),
        sequence.mismatches(F.lit("ACGT"), F.lit("ACCA")),
        F.size(sequence.neighbours(F.lit("ACG"))),
        sequence.phred(F.lit("!I+\r")),
    )
    assert tuple(r) == ("nACGT", "CAA", True, 1 * 1537**2 + 2 * 1537 + 3, 0, "ACTGG", 0, "AC\nGT\nA", "R", 2, 9, [0, 40, 10])


@pytest.mark.parametrize(("quals", "want"), [([9, 9, 1, 9, 9, 9, 1], 6), ([1, 1], 0), ([], 0), ([9, 9], 2), ([9, 1, 9, 1], 0)])
def test_good_length_ends_at_the_last_run(spark, quals, want):
    df = spark.createDataFrame([(quals,)], "q array<int>")
    assert df.select(sequence.good_length("q", 2, 7)).first()[0] == want


def test_numeric_functions(spark):
    r = one(
        spark,
        numeric.poisson_cdf(F.lit(3), F.lit(2.0)),
        numeric.normal_cdf(F.lit(-1.0)),
        numeric.binomial_pmf(F.lit(30), F.lit(60), 0.4),
        numeric.gcd(F.lit(84), F.lit(36)),
        numeric.merged_cigar(F.lit("3M0I2M4S5S")),
        numeric.unclipped(F.lit("2S3M")),
        numeric.combine_normals(F.lit(1.0), F.lit(1.0), F.lit(3.0), F.lit(1.0))["mean"],
    )
    assert math.isclose(r[0], sum(math.exp(-2) * 2**k / math.factorial(k) for k in range(4)), rel_tol=1e-12)
    assert abs(r[1] - 0.5 * math.erfc(1 / math.sqrt(2))) < 1e-7
    assert math.isclose(r[2], math.comb(60, 30) * 0.4**30 * 0.6**30, rel_tol=1e-6)
    assert tuple(r)[3:] == (12, "5M9S", "5M", 2.0)


def test_sets_of_arguments():
    assert ranges.parse_set("{1,4,[7,9]}") == [1, 4, 7, 8, 9] and ranges.parse_set("x,1.5,1") == ["x", 1.5, 1] and ranges.parse_set("") == []


# N-statistics


@pytest.mark.parametrize(("values", "want"), [([2, 3, 4, 5], 4), ([1, 1, 2, 4], 3), ([4, 4], 4), ([1, 2, 3, 4], 3), ([1, 1, 1, 3], 2), ([7], 7), ([], None)])
def test_n50(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v0 long")
    row = nstats.n50(df, "v0").first()
    assert (row.n50 if row else None) == want


def test_levels_by_expansion(spark):
    rng = random.Random(3)
    values = [rng.randint(1, 30) for _ in range(50)]
    expanded = sorted((v for v in values for _ in range(v)), reverse=True)
    rows = nstats.n_levels(spark.createDataFrame([(v,) for v in values], "v0 long"), "v0").collect()
    assert {r.level: r.n for r in rows} == {x: expanded[len(expanded) * x // 100] for x in range(10, 100, 10)}


def test_upper_median(spark):
    for values in ([1, 2], [1, 2, 3], [5], [1, 1, 2, 2]):
        df = spark.createDataFrame([(v,) for v in values], "v0 long")
        assert nstats.upper_median(df, "v0").first().median == sorted(values)[len(values) // 2]


# aggregates


def test_histogram_shrinks_its_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.9,)], "v double")
    assert sorted((round(r.bin, 6), r.n) for r in aggregates.binned(df, "v", 100).collect()) == [(0.0, 1), (0.5, 1), (0.9, 1)]
    assert [(r.bin, r.n) for r in aggregates.binned(spark.createDataFrame([(4.0,)] * 3, "v double"), "v", 10).collect()] == [(4.0, 3)]


def test_greater_alerts_include_the_threshold(spark):
    metrics = spark.createDataFrame([("m", 5.0)], "name string, value double")
    fired = lambda *rules: sorted(r.text for r in aggregates.alerts(metrics, spark.createDataFrame(list(rules), "metric string, threshold double, compare string, action string, text string")).collect())
    assert fired(("m", 5.0, ">", "warn", "a {}"), ("m", 5.0, "<", "warn", "b")) == ["a 5.0"]
    assert fired(("m", 5.0, ">", "warn", "a"), ("m", 6.0, "<", "exit", "stop")) == ["stop"]


def test_shares_of_nothing(spark):
    none = spark.createDataFrame([], "barcode long")
    assert aggregates.valid_barcode_percent(none).first().percent is None


# duplicates


def test_predup_keeps_the_best_and_the_unbarcoded(spark):
    rows = [(1, 5, "AAA", "C", [1], [1]), (2, 5, "AAA", "C", [9], [1]), (3, 5, "AAA", "C", [5], [5]), (4, 0, "AAA", "C", [1], [1]), (5, 0, "AAA", "C", [1], [1]), (6, 6, "AAA", "C", [0], [0])]
    df = spark.createDataFrame(rows, "pair_id long, barcode long, seq1 string, seq2 string, quals1 array<int>, quals2 array<int>")
    assert sorted(r.pair_id for r in dedup.predup(df).collect()) == [2, 4, 5, 6]


def test_first_of_a_key_is_no_duplicate(spark):
    df = spark.createDataFrame([(i, 1, True) for i in range(3)] + [(9, 1, False), (10, 1, False)], "qname int, k int, mapped boolean")
    rows = {r.qname: r.is_duplicate for r in dedup.mark_duplicates(df, ["k"], mapped=F.col("mapped")).collect()}
    assert rows == {0: False, 1: True, 2: True, 9: False, 10: False}


def test_salted_marks_are_the_same(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.choice([1, 1, 1, 2, None]), rng.random() < 0.8) for i in range(200)] * 2, "qname int, k int, mapped boolean")
    of = lambda n: sorted((tuple(r) for r in dedup.mark_duplicates(df, ["k"], mapped=F.col("mapped"), salts=n).collect()), key=repr)
    assert of(1) == of(8)


# joins


def test_demultiplexing(spark):
    white = spark.createDataFrame([("AAAA", 1), ("CCCC", 2), ("AAAC", 3)], "segment string, barcode_id int")
    seqs = ["GGAAAACCCCAAAA", "GGAATACCCGTTTT", "GGAATACCCGAACC", "GGANAACCCCAAAA"]
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, seq string")
    rows = {r.i: r.barcode for r in joins.demultiplex(df, white, start=2, offsets=(0, 4, 8), width=4).collect()}
    # AAAA is one mismatch from the last segment, which claims it; AATA is from the first only
    assert rows == {0: "3_2_3", 1: "0_0_0", 2: "1_2_3", 3: "0_0_0"}


def brute_correction(raw, quals, counts, confidence=0.975):
    total = sum(n + 1 for n in counts.values())
    prior = {b: (n + 1) / total for b, n in counts.items()}
    if raw in prior and all(q > 24 for q in quals):
        return raw
    far = 2 if raw in prior else 1
    found = {raw: prior[raw]} if raw in prior else {}
    for b in counts:
        at = [i for i in range(len(raw)) if raw[i] != b[i]]
        if len(at) == far:
            p = prior[b]
            for i in at:
                q = min(33, quals[i]) if far == 1 else min(33, max(3, quals[i] - 1))
                p *= 10 ** (-q / 10)
            found[b] = p
    if len(found) < 2:
        return None
    best = max(found.items(), key=lambda x: (x[1], x[0]))
    return best[0] if best[1] / sum(found.values()) > confidence else None


def test_barcode_correction_against_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(w) for w in itertools.product("ACG", repeat=4)]
    counts = {w: rng.choice([0, 1, 5, 200, 3000]) for w in rng.sample(words, 25)}
    reads = [(i, rng.choice(words), [rng.choice([2, 10, 26, 40]) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(reads, "read_id long, raw string, quals array<int>")
    got = {r.read_id: r.barcode for r in joins.correct_barcodes(df, spark.createDataFrame(list(counts.items()), "barcode string, n long")).collect()}
    assert got == {i: brute_correction(raw, quals, counts) for i, raw, quals in reads}
    assert len({b is None for b in got.values()}) == 2


def test_unique_candidate_is_rejected(spark):
    df = spark.createDataFrame([(1, "AAAT", [2, 2, 2, 2]), (2, "AAAA", [30, 30, 30, 30])], "read_id long, raw string, quals array<int>")
    got = joins.correct_barcodes(df, spark.createDataFrame([("AAAA", 10), ("GGGG", 1)], "barcode string, n long")).collect()
    assert {r.read_id: r.barcode for r in got} == {1: None, 2: "AAAA"}


def test_interval_join_finds_each_pair_once(spark):
    rng = random.Random(2)
    make = lambda n: [(i, rng.randint(0, 3), s := rng.randint(-50, 300), s + rng.randint(0, 90)) for i in range(n)]  # noqa: E731, F841
    a, b = make(80), make(80)
    schema = "id int, g int, start long, stop long"
    got = joins.interval_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 25, ["g"])
    want = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3] and x[2] < x[3] and y[2] < y[3]]
    assert sorted((r.l_id, r.r_id) for r in got.collect()) == sorted(want)


def test_nearest_takes_the_first_of_ties(spark):
    entries = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (7.0, "c")], "k double, r string")
    df = spark.createDataFrame([(v,) for v in (-5.0, 1.0, 2.0, 2.1, 5.0, 6.0, 99.0)], "v double")
    assert [r.r for r in joins.nearest(df, entries, "v", "k", "r").orderBy("v").collect()] == ["a", "a", "a", "b", "b", "c", "c"]



def test_nearest_in_a_table_of_any_size(spark, monkeypatch):
    rng = random.Random(3)
    entries = [(round(rng.uniform(-999, 9999), 2), i) for i in range(3000)] + [(10.0, -5), (10.0, -4), (30.0, -6)]
    values = [round(rng.uniform(-2000, 12000), 2) for _ in range(2000)] + [20.0, 10.0, -1e9, 1e9, None] + [5.5] * 500
    keys = {}
    for k, r in entries:
        keys[k] = min(r, keys.get(k, r))
    want = [(i, keys[min(keys, key=lambda k: (0 if v is None else abs(v - k), k))]) for i, v in enumerate(values)]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double").repartition(5)
    table = spark.createDataFrame(entries, "k double, r long").repartition(3)
    for most in (20_000, 100):
        monkeypatch.setattr(joins, "PLAN_ENTRIES", most)
        got = joins.nearest(df, table, "v", "k", "r").select("i", "v", "r").collect()
        assert sorted((r.i, r.r) for r in got) == want
    # few keys among many values: whole ranges are without one
    few = spark.createDataFrame([(100.0, "a"), (5000.0, "b")], "k double, r string")
    monkeypatch.setattr(joins, "PLAN_ENTRIES", 1)
    got = {r.i: r.r for r in joins.nearest(df, few, "v", "k", "r").collect()}
    assert got == {i: "a" if v is None or abs(v - 100) <= abs(v - 5000) else "b" for i, v in enumerate(values)}


def test_nearest_takes_more_entries_than_a_plan_holds(spark):
    table = spark.range(30_001).selectExpr("id * 2.0D AS k", "id AS r")
    got = joins.nearest(spark.createDataFrame([(3.0,), (60_000.5,), (41_234.9,)], "v double"), table, "v", "k", "r").collect()
    assert sorted((r.v, r.r) for r in got) == [(3.0, 1), (41_234.9, 20_617), (60_000.5, 30_000)]


def test_end_overlap_thresholds(spark):
    near = [(e, b, 6) for e in (1, 2) for b in range(20)] + [(4, b, 5) for b in range(20)] + [(3, b, 6) for b in range(20)]
    far = [(e, 100 + b, 6) for e in (1, 2) for b in range(10)]
    schema = "end long, barcode long, reads long"
    rows = joins.end_overlaps(spark.createDataFrame(near, schema), spark.createDataFrame(far, schema)).collect()
    # ends 2 and 3 are of one scaffold; the barcodes of end 4 have too few reads; 1 and 3 share no far barcodes
    assert [(r.a, r.b, r.common, r.far_common) for r in rows] == [(1, 2, 20, 10)]


# k-mers


def test_support_of_kmers(spark):
    rows = [(1, "AACCGT"), (1, "AACCGT"), (1, "AACCGT"), (2, "AACC"), (-1, "GGGGT"), (-1, "GGGGT"), (-1, "GGGGT")]
    df = spark.createDataFrame(rows, "barcode long, seq string")
    got = {r.kmer: (r.n, r.barcodes) for r in kmers.count(df, 3, 3, 2).collect()}
    # ACC is also GGT on the other strand; CCG has one barcode only
    assert got["AAC"] == (4, 2) and got["ACC"] == (7, 2) and "CCG" not in got and got["CCC"] == (6, 0)


def test_context_of_kmers(spark):
    df = spark.createDataFrame([(-1, "TACA"), (-1, "GACT")], "barcode long, seq string")
    got = {r.kmer: r.context for r in kmers.count(df, 2, 1, 0).collect()}
    # AC: T and G precede; A and T follow
    assert got["AC"] == (8 | 4) | (1 << 4 | 8 << 4)


def test_spectrum_regions(spark):
    counts = [(1, 1000), (2, 100), (3, 20), (4, 30), (5, 60), (6, 40), (7, 20), (10, 100), (11, 500), (12, 300), (20, 10), (24, 5)]
    r = kmers.spectrum_regions(spark.createDataFrame(counts, "count long, kmers long"), 21).first()
    assert (r.trough, r.peak, r.snp, r.high) == (3, 11, 5, 27)
    assert math.isclose(r.genome, sum(c * n for c, n in counts if c > 3) / 11) and math.isclose(r.repeats, (20 * 10 + 24 * 5) / 11)


# windows


def test_molecule_breaks(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 10), (1, 1, 60_011), (1, 1, 120_011)], "line int, barcode int, pos long")
    rows = windows.sessions(df, ["line", "barcode"], F.col("pos"), 60_000).orderBy("pos").collect()
    assert [r.session for r in rows] == [0, 0, 1, 1]


def test_character_runs(spark):
    df = spark.createDataFrame([(1, "ACNNNGTNNANNN"), (2, ""), (3, "NNNN"), (4, None)], "i int, seq string")
    assert sorted(map(tuple, windows.character_runs(df, ["i"], "seq", "Nn", 3).collect())) == [(1, 2, 5), (1, 10, 13), (3, 0, 4)]


def test_called_coordinates(spark):
    seq = "ACNNGTNNNA"
    gaps = spark.createDataFrame([(0, 2, 4), (0, 6, 9)], "scaffold_id long, start long, stop long")
    places = [i for i, c in enumerate(seq) if c != "N"]
    points = spark.createDataFrame([(0, i) for i in range(len(places))], "scaffold_id long, pos long")
    got = {r.pos: r.scaffold_pos for r in windows.called_coordinate(gaps, points).collect()}
    assert got == dict(enumerate(places))


def test_peaks(spark):
    curve = [(float(x), 100 * math.exp(-((x - 40) ** 2) / 50) + 30 * math.exp(-((x - 80) ** 2) / 50) + 1) for x in range(120)]
    rows = windows.peaks(spark.createDataFrame(curve, "x double, y double")).collect()
    assert sorted(r.x for r in rows) == [40.0, 80.0]


def test_gap_sizes(spark):
    """A uniform genome: gaps are found about as large as they are, and 30 000 without evidence."""
    rng = random.Random(1)
    length, window = 400_000, 10_000
    points = [(0, p + rng.randrange(20_000), b) for b, p in enumerate(rng.randrange(length - 20_000) for _ in range(3000)) for _ in range(12)]
    cut = 200_000
    halves = [(1, p, b) for _, p, b in points if p < cut - 4000] + [(2, p - cut - 4000, b) for _, p, b in points if p >= cut + 4000]
    schema = "scaffold_id long, pos long, barcode long"
    df = spark.createDataFrame(points + halves, schema)
    scaffolds = spark.createDataFrame([(0, length), (1, cut - 4000), (2, cut - 4000), (3, 500)], "scaffold_id long, length long")
    gaps = spark.createDataFrame([], "scaffold_id long, start long, stop long")
    calibration = windows.calibrate_gaps(df.where("scaffold_id = 0"), scaffolds.where("scaffold_id = 0"), gaps, window, 20_000, 5000, 1)
    fractions = [r.fraction for r in calibration.orderBy("gap").collect()]
    assert len(fractions) == 5 and fractions == sorted(fractions, reverse=True)
    asked = spark.createDataFrame([(7, 1, True, 2, False), (8, 1, True, 3, False)], "join_id long, a long, a_tail boolean, b long, b_tail boolean")
    got = {r.join_id: r.gap for r in windows.estimate_gaps(asked, df, scaffolds, gaps, calibration, window, 1).collect()}
    assert 3000 <= got[7] <= 12_000 and got[8] == windows.DEFAULT_GAP


# orders


def test_samples(spark):
    df = spark.range(200).select((F.col("id") / 2).cast("long").alias("pair_id"), (F.col("id") % 2).alias("mate"))
    ids = [r.pair_id for r in sorting.sample_pairs(df, 0.4).collect()]
    assert all(ids.count(i) == 2 for i in ids) and 20 < len(set(ids)) < 60
    exact = [r.pair_id for r in sorting.sample_exactly(df, 17).collect()]
    assert len(exact) == 34 and len(set(exact)) == 17 and sorting.sample_exactly(df, 1000).count() == 200
    assert sorting.sampling_rate(10.0, rate=2) == 1.0 and sorting.sampling_rate(4e9, gigabases=1) == 0.25
    with pytest.raises(ValueError):
        sorting.sampling_rate(1.0, gigabases=1, rate=0.5)


def test_range_buckets_keep_keys_together(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "k int, i int")
    rows = sorting.bucket_by_range(df, 5, "k").collect()
    where = {}
    for r in rows:
        where.setdefault(r.k, set()).add(r.bucket)
    assert len(rows) == 500 and all(len(v) == 1 for v in where.values())
    assert [next(iter(where[k])) for k in range(7)] == sorted(next(iter(where[k])) for k in range(7))


def test_barcode_order(spark):
    rows = [(0, 2, "A", "C"), (1, 0, "A", "A"), (2, 2, "G", "A"), (3, 0, "T", "T"), (4, 1, "A", "A"), (5, 2, "A", "G")]
    df = spark.createDataFrame(rows, "read_id long, barcode long, seq1 string, seq2 string")
    assert [r.read_id for r in sorting.barcode_order(df).collect()] == [1, 3, 4, 2, 5, 0]


# sets and graphs


def test_redundancy(spark):
    names = spark.createDataFrame([(n,) for n in "abcdefg"], "name string")
    inside = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "f"), ("f", "g")], "a string, b string")
    # a and b hold each other, c lies in both; d only holds itself; e in f in g
    assert sorted(r.name for r in sets.maximal(names, inside).collect()) == ["a", "d", "g"]
    paf = spark.createDataFrame([("x", 11, "y", 9), ("x", 11, "z", 10), ("x", 11, "x", 11)], "q string, qlen int, t string, alen int")
    assert [tuple(r) for r in sets.containment(paf).collect()] == [("x", "z")]


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)] + [(500, x) for x in range(501, 560)]
    roots = {}

    def find(x):
        roots.setdefault(x, x)
        while roots[x] != x:
            x = roots[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        roots[y] = x
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in roots)


def test_cycles_and_strong_components(spark):
    of = lambda *e: spark.createDataFrame(list(e), "a long, b long")
    assert graph.is_cyclic(of((1, 2), (2, 3), (3, 2))) and not graph.is_cyclic(of((1, 2), (1, 3), (2, 3)))
    assert sorted(map(tuple, graph.strong_components(of((1, 2), (2, 3), (3, 2), (3, 4))).collect())) == [(2, 2), (3, 2)]


def test_chains(spark):
    # tail of 0 to head of 1, tail of 1 to tail of 2; 3 and 4 form a ring; two links at the head of 5
    links = [(1, 2), (3, 5), (7, 8), (9, 6), (10, 13), (10, 15)]
    got = sorted(map(tuple, graph.chains(spark.createDataFrame(links, "a long, b long")).select("chain", "ordinal", "scaffold", "reversed").collect()))
    assert got == [(0, 0, 0, False), (0, 1, 1, False), (0, 2, 2, True)]
    whole = graph.with_singletons(graph.chains(spark.createDataFrame(links, "a long, b long")), spark.range(8).select(F.col("id").alias("scaffold")))
    assert sorted(r.scaffold for r in whole.collect()) == list(range(8))
    zero = spark.createDataFrame([(0, 3), (2, 5)], "a long, b long")
    assert len({r.chain for r in graph.chains(zero).collect()}) == 1
    assert sorted(r.scaffold for r in graph.chains(zero, zero_is_none=True).collect()) == [1, 2]


def test_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(2 * i + 1, 2 * i + 2) for i in range(n)], "a long, b long")
    rows = graph.chains(links).orderBy("ordinal").collect()
    assert [r.scaffold for r in rows] == list(range(n + 1)) and {r.chain for r in rows} == {0}


def test_unitigs(spark):
    rng = random.Random(6)
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    a, b, c = ("".join(rng.choice("ACGT") for _ in range(60)) for _ in range(3))
    df = spark.createDataFrame([(1, a + b), (2, a + c)], "read_id long, seq string")
    rows = kmers.canonical_kmers(df, 21).select("kmer").distinct()
    got = {r.seq for r in graph.unitigs(rows).collect()}
    common = 60 if b[0] != c[0] else None
    if common:
        assert got == {min(s, rc(s)) for s in (a, a[-20:] + b, a[-20:] + c)}
    ring = "".join(rng.choice("ACGT") for _ in range(50))
    circle = kmers.canonical_kmers(spark.createDataFrame([(1, ring + ring[:20])], "read_id long, seq string"), 21).select("kmer").distinct()
    assert {len(r.seq) for r in graph.unitigs(circle).collect()} == {70}


def test_cleaning(spark):
    edges = spark.createDataFrame([(1, 0, 1, 100, 11), (2, 1, 2, 100, 12), (3, 1, 3, 5, 13), (11, 9, 8, 100, 1), (13, 7, 8, 5, 3)], "edge long, a long, b long, length long, rc long")
    hangs = graph.simple_hangs(edges, 10, 10)
    assert [r.edge for r in hangs.collect()] == [3]
    assert sorted(r.edge for r in graph.delete(edges, hangs).collect()) == [1, 2, 11]
    bubble = spark.createDataFrame([(1, 0, 1, 50, 0), (2, 0, 1, 52, 0), (3, 1, 2, 9, 0)], "edge long, a long, b long, length long, rc long")
    pairs = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0), (2, 100)], "edge long, pair_id long")
    assert [r.edge for r in graph.weak_bubbles(bubble, pairs, 5, 2, 5).collect()] == [2]
    copies = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "edge long, multiplicity int")
    assert sorted(r.edge for r in graph.low_unique(bubble, copies, 103).collect()) == [1, 2, 3] and graph.low_unique(bubble, copies, 102).count() == 0
    split = graph.splay(bubble, spark.createDataFrame([(1,)], "node long"))
    assert len({r.b for r in split.where("edge < 3").collect()}) == 2 and {r.a for r in split.where("edge < 3").collect()} == {"0"}
    path = spark.createDataFrame([(1, 0, 5, 6), (1, 1, 9, 90), (1, 2, 6, 5)], "line int, ordinal int, edge long, rc long")
    assert [r.edge for r in graph.inversion_bubbles(path).collect()] == [9]
    ends = spark.createDataFrame([(s, p, m, line, line + 50, d) for s, p in ((1, 1), (1, 2), (2, 3)) for m, line, d in ((0, 7, 300), (1, 8, 600))], "support_id long, pair_id long, mate int, line long, rc_line long, distance long")
    assert [tuple(r) for r in graph.pair_links(ends).collect()] == [(7, 58, 2)]


def test_interval_sweeps_against_positions(spark):
    rng = random.Random(7)
    spans = [(rng.randint(0, 2), s := rng.randint(0, 60), s + rng.randint(0, 12)) for _ in range(60)]  # noqa: F841
    df = spark.createDataFrame(spans, "line int, start long, stop long")
    depth = {(n, p): sum(x == n and a <= p < b for x, a, b in spans) for n in range(3) for p in range(80)}
    for name, rows, want in (
        ("merged", intervals.merged(df, ["line"]), lambda d: d > 0),
        ("twice", intervals.covered_at(df, 2, ["line"]), lambda d: d >= 2),
    ):
        got = {(r.line, p) for r in rows.collect() for p in range(r.start, r.stop)}
        assert got == {k for k, d in depth.items() if want(d)}, name
    for r in intervals.classes(df, ["line"]).collect():
        assert all(depth[r.line, p] == r.depth for p in range(r.start, r.stop))
        assert depth[r.line, r.stop] != r.depth or r.depth == 0


def test_summary_of_kmers_makes_no_row_a_window(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows = [(1, word(300)), (2, word(21)), (3, word(20)), (4, None), (5, ""), (6, word(90)), (6, word(40)), (None, word(25)), (None, word(30)), (7, "AC" * 40), (8, "T" * 60)]
    monkeypatch.setattr(kmers, "WINDOWS", 50)
    got = kmers.summary(spark.createDataFrame(rows, "read_id long, seq string").repartition(3), 21, "read_id")
    want = {}
    for owner, seq in rows:
        want.setdefault(owner, []).extend(seq[i : i + 21] for i in range(len(seq or "") - 20))
    rc = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    code = lambda x: int(x.translate(str.maketrans("ACTG", "0123")), 4)
    assert {tuple(r) for r in got.collect()} == {
        (o, len(w), sum(x >= rc(x) for x in w), min(min(x, rc(x)) for x in w), max(min(x, rc(x)) for x in w), sum(code(x) % 1000003 for x in w), max(x[1:] + "C" for x in w), min("G" + x[:-1] for x in w))
        for o, w in want.items()
        if w
    }
    for k in (1, 2, 5, 16, 31):
        text = word(80)
        codes, back = kmers.packed(kmers.np.array(["ACGT".index(c) for c in text], kmers.np.uint8), k)
        number = lambda x: int(x.translate(str.maketrans("ACGT", "0123")), 4)
        assert codes.tolist() == [number(text[i : i + k]) for i in range(81 - k)] and back.tolist() == [number(rc(text[i : i + k])) for i in range(81 - k)]


def test_canonical_kmer_sorts_no_windows(spark):
    plan = catalog.canonical_kmer(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "explode" not in plan.lower() and "SortAggregate" not in plan
