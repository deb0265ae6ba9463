import random

import pytest
from pyspark.sql import functions as F

from braidlake.functions import ambiguous
from braidlake.operators import alignment, lines
from braidlake.plans import stages
from braidlake.sources import text

MATCH, MISMATCH, OPEN, EXTEND = 1, -3, -5, -2


def brute_score(q, t, mode):
    """Plain three-state scores."""
    n, m, low = len(q), len(t), -(10**6)
    edge = lambda k: 0 if k == 0 or mode != "global" else OPEN + EXTEND * (k - 1)
    h = [[edge(i + j) if i == 0 or j == 0 else low for j in range(m + 1)] for i in range(n + 1)]
    e = [[low] * (m + 1) for _ in range(n + 1)]
    f = [[low] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            e[i][j] = max(h[i][j - 1] + OPEN, e[i][j - 1] + EXTEND)
            f[i][j] = max(h[i - 1][j] + OPEN, f[i - 1][j] + EXTEND)
            h[i][j] = max(h[i - 1][j - 1] + (MATCH if q[i - 1] == t[j - 1] else MISMATCH), e[i][j], f[i][j], 0 if mode == "local" else low)
    if mode == "local":
        return max(map(max, h))
    return h[n][m] if mode == "global" else max([*h[n], *(r[m] for r in h)])


def rescored(q, t, got):
    """The score that a CIGAR stands for, and that it spans what it says."""
    import re

    score, qs, qe, ts, te, cigar = got
    i, j, total = qs, ts, 0
    for n, o in re.findall(r"(\d+)([MID])", cigar):
        n = int(n)
        if o == "M":
            total += sum(MATCH if q[i + k] == t[j + k] else MISMATCH for k in range(n))
            i, j = i + n, j + n
        else:
            total += OPEN + EXTEND * (n - 1)
            i, j = (i + n, j) if o == "I" else (i, j + n)
    assert (i, j) == (qe, te)
    return total


@pytest.mark.parametrize("mode", ["local", "free", "global"])
def test_alignment_scores(mode):
    rng = random.Random(5)
    for _ in range(60):
        t = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 14)))
        q = "".join(c if rng.random() > 0.2 else rng.choice(["", "A", c + "G"]) for c in t)
        got = alignment.align(q, t, mode=mode)
        assert got[0] == brute_score(q, t, mode)
        assert rescored(q, t, got) == got[0]


def test_aligned_columns(spark):
    df = spark.createDataFrame([(1, "ACGTACGT", "TTACGTACGTTT"), (2, None, "A"), (3, "", "")], "i int, query string, target string")
    rows = {r.i: r for r in alignment.aligned(df).collect()}
    assert (rows[1].score, rows[1].cigar, rows[1].target_start) == (8, "8M", 2) and rows[2].score is None and rows[3].score == 0
    assert alignment.align("ACGT", "ACGT", band=0)[5] == "4M"


def test_pileup_and_consensus(spark, tmp_path):
    sam = ["r1\t0\tx\t3\t60\t1S2M1D2M\t*\t0\t0\tTACGG\tIIIII", "r2\t0\tx\t3\t60\t2M1I3M\t*\t0\t0\tACTCGT\t*", "r3\t4\t*\t0\t0\t*\t*\t0\t0\tAC\t*"]
    (tmp_path / "a.sam").write_text("\n".join(sam) + "\n")
    columns = alignment.pileup(text.sam(spark, f"{tmp_path}/a.sam"))
    got = sorted((r.pos, r.base, r.quality) for r in columns.collect() if r.quality is not None)
    assert got == [(2, "A", 40), (3, "C", 40), (5, "G", 40), (6, "G", 40)]
    best = {r.pos: (r.base, r.depth) for r in alignment.consensus(columns).collect()}
    assert best == {2: ("A", 2), 3: ("C", 2), 4: ("C", 1), 5: ("G", 2), 6: ("G", 2)} or best[6] == ("G", 2)
    assert alignment.consensus_sequences(alignment.consensus(columns)).first().seq[:2] == "AC"


def test_errors_in_reads_are_put_right(spark):
    rng = random.Random(2)
    whole = "".join(rng.choice("ACGT") for _ in range(120))
    wrong = whole[:60] + ("A" if whole[60] != "A" else "C") + whole[61:]
    df = spark.createDataFrame([(i, whole) for i in range(4)] + [(9, wrong)], "read_id long, seq string")
    found = alignment.error_candidates(df, 15)
    assert [(r.read_id, r.pos, r.base, r.correct) for r in found.collect()] == [(9, 60, wrong[60], whole[60])]
    assert {r.seq for r in alignment.corrected(df, found).collect()} == {whole}


def test_perfect_stretches_and_misjoins(spark):
    want = spark.createDataFrame([("x", i, "A") for i in range(10)], "rname string, pos long, base string")
    got = want.withColumn("base", F.when(F.col("pos") == 3, "C").otherwise("A"))
    r = alignment.perfect_stretches(got, want).first()
    assert (r.perfect_n50, r.errors_per_kb) == (6, 100.0)
    paf = spark.createDataFrame([("q", 0, 100, "+", "t", 0, 100), ("q", 110, 200, "+", "t", 115, 205), ("q", 210, 300, "-", "t", 300, 390), ("p", 0, 9, "+", "t", 0, 9), ("p", 9, 20, "+", "u", 0, 11)], "q string, qs int, qe int, strand string, t string, ts int, te int")
    assert {r.q: r.breaks for r in alignment.misjoins(paf).collect()} == {"q": 1, "p": 1}


def test_lines_of_bubbles(spark):
    # 1 -> bubble (2 | 3,4) -> 5, and apart from it 6
    edges = [(1, 0, 1, 100), (2, 1, 3, 50), (3, 1, 2, 20), (4, 2, 3, 20), (5, 3, 4, 90), (6, 10, 11, 5)]
    df = spark.createDataFrame(edges, "edge long, a long, b long, length long")
    parts = lines.lines(df)
    got = sorted((r.line, r.cell, r.branch, r.ordinal, r.edge) for r in parts.collect())
    assert got == [("0_0", 0, 0, 0, 1), ("0_0", 1, 0, 0, 2), ("0_0", 1, 1, 0, 3), ("0_0", 1, 1, 1, 4), ("0_0", 2, 0, 0, 5), ("10_0", 0, 0, 0, 6)]
    starts = {r.edge: r.start for r in lines.edge_offsets(parts, df).collect()}
    assert starts == {1: 0, 2: 100, 3: 100, 4: 120, 5: 145, 6: 0}
    paths = spark.createDataFrame([(0, 7, 5, [2, 5]), (3, 7, 1, [1]), (4, 0, 1, [1]), (6, 7, 1, [])], "read_id long, barcode long, offset long, edges array<long>")
    assert sorted(map(tuple, lines.barcode_positions(paths, lines.edge_offsets(parts, df)).collect())) == [("0_0", 7, 1, 1), ("0_0", 7, 105, 0)]


def test_every_edge_is_on_one_line(spark):
    rng = random.Random(1)
    edges = [(i, rng.randrange(30), rng.randrange(30, 60), rng.randint(1, 9)) for i in range(40)] + [(100 + i, 60 + i, 61 + i, 5) for i in range(20)]
    parts = lines.lines(spark.createDataFrame(edges, "edge long, a long, b long, length long")).collect()
    assert sorted(r.edge for r in parts) == sorted(e[0] for e in edges)


def test_placements_prefer_home(spark):
    hits = spark.createDataFrame([(1, 5, 1, 100, 9), (1, 5, 2, 500, 7), (2, 6, 1, 1, 3), (2, 6, 1, 2, 3)], "read_id long, barcode long, line long, pos long, kmers long")
    home = spark.createDataFrame([(5, 2, 400, 600)], "barcode long, line long, start long, stop long")
    assert sorted(map(tuple, lines.placements(hits, home).collect())) == [(1, 2, 500, 7, True), (2, 1, 1, 3, False)]


def test_edge_kinds(spark):
    df = spark.createDataFrame([([4, 5],), ([-1],), ([-2, 700],), ([-3, 1, 2, 9],), ([-4, 0],)], "e array<int>")
    assert [(r.kind, r.path, r.gap, r.ltrim, r.rtrim) for r in lines.decoded(df).collect()] == [("path", [4, 5], None, None, None), ("pair", None, None, None, None), ("barcode", None, 700, None, None), ("sequence", None, None, 1, 2), ("cell", None, None, None, None)]


def test_graph_checks(spark):
    good = spark.createDataFrame([(1, 0, 1, 5, 2), (2, 8, 9, 5, 1)], "edge long, a long, b long, length long, rc long")
    assert set(lines.check_graph(good).values()) == {0}
    bad = spark.createDataFrame([(1, 0, 1, 5, 2), (2, 8, 9, 0, 3), (4, 8, 9, 1, 7)], "edge long, a long, b long, length long, rc long")
    assert lines.check_graph(bad) == {"missing_strand": 2, "not_mutual": 1, "unequal_length": 1, "empty": 1, "repeated_id": 0}
    assert lines.checksum(good) == lines.checksum(good.repartition(3)) != lines.checksum(bad)


def test_alternatives(spark):
    r = spark.range(1).select(ambiguous.versions(F.lit("A{C,GT}{,A}T")).alias("v"), ambiguous.ambiguities(F.lit("A{C,GT}{,A}T")).alias("n"), ambiguous.lengths(F.lit("A{C,GT}{,A}T")).alias("l"), ambiguous.first_version(F.lit("{C,G}")).alias("f")).first()
    assert (sorted(r.v), r.n, tuple(r.l), r.f) == (["ACAT", "ACT", "AGTAT", "AGTT"], 2, (3, 5), "C")


def test_stages_are_taken_up_again(spark, tmp_path):
    ran = []

    def stage(name):
        def of(spark, tables):
            ran.append(name)
            return {name: tables["in"].withColumn("by", F.lit(name))}

        return name, of

    plan, inputs = [stage("a"), stage("b"), stage("c")], {"in": spark.range(3)}
    out = stages.run(spark, plan, inputs, f"{tmp_path}/run")
    assert ran == ["a", "b", "c"] and set(out) == {"in", "a", "b", "c"} and out["c"].count() == 3
    stages.run(spark, plan, inputs, f"{tmp_path}/run")
    assert ran == ["a", "b", "c"]
    stages.run(spark, plan, inputs, f"{tmp_path}/run", start="b")
    assert ran == ["a", "b", "c", "b", "c"]


def test_neighbours_are_oriented(spark):
    """Barcodes cross the seam from the end of line 1 to the end of line 2, which is thus turned round."""
    rng = random.Random(3)
    size, rows = 20_000, []
    for b in range(1, 200):
        start = rng.randrange(2 * size - 6000)
        for _ in range(12):
            at = start + rng.randrange(6000)
            rows.append((1, b, at) if at < size else (2, b, 2 * size - at - 1))
    positions = spark.createDataFrame(rows, "line long, barcode long, pos long")
    facts = spark.createDataFrame([(1, size, 1.0), (2, size, 1.2), (3, size, 3.0), (4, 100, 1.0)], "line long, length long, copies double")
    neighbours = spark.createDataFrame([(1, 2, 50), (1, 3, 90), (1, 4, 99)], "owner long, neighbour long, common long")
    pairs = lines.star_candidates(neighbours, facts)
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
    best = lines.orientations(positions, facts, pairs)
    assert [(r.side, r.reversed) for r in best.collect()] == [("after", True)]
    assert [tuple(r) for r in lines.next_lines(best, facts).collect()] == [(1, 2, True)]


def test_local_alignments_take_whole_sequences(spark, tmp_path):
    """A match of 60 that begins after the first 100 characters."""
    from braidlake.plans import catalog

    rng = random.Random(3)
    shared = "".join(rng.choice("abcd") for _ in range(60))
    texts = ["a" * 130 + shared, "c" * 140 + shared + "c" * 20]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    (r,) = catalog.QUERIES["local_alignments"](spark, str(tmp_path)).collect()
    assert (len(r.query), len(r.target)) == (190, 220)
    assert (r.score, r.query_start, r.query_stop, r.target_start, r.target_stop, r.cigar) == (60, 130, 190, 140, 200, "60M")


def test_graph_distances_keep_far_nodes(spark, tmp_path):
    """A chain of 15 steps from node 1."""
    from braidlake.plans import catalog

    parts = [next(p for p in range(a, a + 400 * 401, 400) if p * 7 % 401 == a + 1) for a in range(1, 16)]
    spark.createDataFrame([(p,) for p in parts], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    rows = catalog.QUERIES["graph_distances"](spark, str(tmp_path)).collect()
    assert {r.node: r.distance for r in rows} == {a: a - 1 for a in range(1, 17)}
