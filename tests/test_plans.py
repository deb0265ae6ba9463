import gzip
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from braidlake.plans import gap_close, ingest, rescaffold
from braidlake.streaming import events

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s[::-1].translate(COMPLEMENT)


def genome(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


# ingest


def test_ingest(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        bc = rng.choice(["0_0_0", "1_1_1", "1_1_2", "2_1_1"])
        a, b = genome(50, i), genome(50, 100 + i)
        rows.append((f"r{i}#{bc}", a, b))
    rows.append(("again#1_1_1", *next(r for r in rows if r[0].endswith("1_1_1"))[1:]))
    for n in (1, 2):
        body = "".join(f"@{name}/{n}\n{(a, b)[n - 1]}\n+\n{'I' * 50}\n" for name, a, b in rows)
        (tmp_path / f"{n}.fq.gz").write_bytes(gzip.compress(body.encode()))
    out = ingest.run(spark, f"{tmp_path}/1.fq.gz", f"{tmp_path}/2.fq.gz", f"{tmp_path}/out")
    got = out.collect()
    assert len(got) == len(rows) - 1
    assert sum(r.barcode == 0 for r in got) == sum(n.endswith("#0_0_0") for n, _, _ in rows)
    metrics = {r.name: r.value for r in ingest.read_metrics(out).collect()}
    assert metrics["reads"] == 2 * len(got) and metrics["barcodes"] == 3
    ordered = [(r.barcode, r.seq1) for r in ingest.barcode_sorted(out).collect() if r.barcode]
    assert ordered == sorted(ordered, key=lambda x: (x[0], [-ord(c) for c in x[1]]))


def test_demultiplexed(spark, tmp_path):
    (tmp_path / "list").write_text("ACGTACGTAC\t1\nTTTTTCCCCC\t2\n")
    white = ingest.whitelist(spark, f"{tmp_path}/list")
    second = genome(20, 1) + "ACGTACGTAC" + "GATCGA" + "TTTTTCCCCA" + "GATCGA" + "ACGTACGTAC"
    (tmp_path / "1.fq").write_text(f"@x/1\n{genome(20, 2)}\n+\n{'I' * 20}\n")
    (tmp_path / "2.fq").write_text(f"@x/2\n{second}\n+\n{'I' * len(second)}\n")
    r = ingest.demultiplexed(spark, f"{tmp_path}/1.fq", f"{tmp_path}/2.fq", white, 20).first()
    assert (r.barcode, r.seq2, len(r.qual2)) == ("1_2_1", second[:20], 20)
    assert ingest.trimmed(ingest.demultiplexed(spark, f"{tmp_path}/1.fq", f"{tmp_path}/2.fq", white, 20), 5, 2).first().seq2 == second[2:20]


def test_preflight_and_chunks(spark):
    assert ingest.preflight({"first": "/a.gz", "second": "/b.gz", "barcode_length": 16, "lanes": [1], "library": "x-1"}) == []
    assert len(ingest.preflight({"first": "a.gz", "second": "/b", "barcode_length": 5, "lanes": [0], "library": "x y", "rate": 2})) == 6
    names = ["/d/read-RA_si-AAAA_lane-1_chunk-1.fastq", "/d/s_S3_L002_R2_001.fastq.gz", "/d/notes.txt"]
    rows = sorted(tuple(r)[1:] for r in ingest.chunks(spark.createDataFrame([(n,) for n in names], "path string")).collect())
    assert rows == [("3", 2, "R2", 1), ("AAAA", 1, "RA", 1)]
    files = spark.createDataFrame([("a", 1000, False), ("b", 1000, True)], "path string, bytes long, compressed boolean")
    sample = spark.createDataFrame([("a", 10, 500, 100), ("b", 10, 500, 100)], "path string, reads long, bases long, bytes long")
    assert {r.path: (r.reads, r.bases) for r in ingest.estimated_reads(files, sample).collect()} == {"a": (100, 5000), "b": (80, 4000)}


# re-scaffolding


def test_rescaffold_joins_what_shares_barcodes(spark):
    rng = random.Random(3)
    size, window = 30_000, 3000
    whole = genome(4 * size, 5)
    # a, b and c are one after the other, b the other way round; d is elsewhere, e is a copy of most of d
    cuts = {"a": (0, size), "b": (size + 500, 2 * size), "c": (2 * size + 500, 3 * size), "d": (3 * size + 20_000, 4 * size)}
    seqs = {n: whole[x:y] for n, (x, y) in cuts.items()}
    seqs["b"] = rc(seqs["b"])
    seqs["e"] = seqs["d"][:9000]
    points = []
    for barcode in range(700):
        start = rng.randrange(3 * size - 16_000)
        for _ in range(60):
            at = start + rng.randrange(16_000)
            for n, (x, y) in cuts.items():
                if x <= at < y:
                    points.append((n, at - x if n != "b" else y - at - 1, f"b{barcode}"))
    scaffolds = spark.createDataFrame(list(seqs.items()), "name string, seq string")
    paf = spark.createDataFrame([("e", 9000, "d", 8900)], "q string, qlen int, t string, alen int")
    out = rescaffold.run(scaffolds, spark.createDataFrame(points, "scaffold string, pos long, barcode string"), paf, molecule=4 * window)
    chains = {}
    for r in out["chains"].collect():
        chains.setdefault(r.chain, []).append((r.ordinal, r.name, r.reversed))
    shapes = sorted([(n, v) for _, n, v in sorted(c)] for c in chains.values())
    assert [[n for n, _ in s] for s in shapes] in ([["a", "b", "c"], ["d"]], [["c", "b", "a"], ["d"]])
    strand = {n: v for n, v in shapes[0]}
    assert strand["a"] == strand["c"] != strand["b"]
    text = sorted(r.value for r in out["text"].collect())
    assert len(text) == 2 and "e" not in {w for t in text for w in t.split("\n")[0].split()}


# gap closing


def test_gaps_are_closed_by_long_reads(spark):
    whole = genome(3000, 9)
    scaffold = whole[:1000] + "N" * 70 + whole[1100:2000] + "N" * 50 + whole[1990:]
    reads = [whole[600:1500], rc(whole[700:1400]), whole[650:1450], whole[1600:2400], rc(whole[1700:2300]), genome(500, 77)]
    out = gap_close.run(
        spark.createDataFrame([(0, "s", scaffold), (1, "t", genome(300, 4) + "NNN" + genome(300, 5))], "scaffold_id long, name string, seq string"),
        spark.createDataFrame(list(enumerate(reads)), "read_id long, seq string"),
    )
    fillers = {(r.scaffold_id, r.ordinal): (r.size, r.support, r.filler) for r in out["fillers"].collect()}
    assert fillers == {(0, 1): (100, 3, whole[1000:1100]), (0, 2): (-10, 2, "")}
    seqs = {r.name: r.seq for r in out["scaffolds"].collect()}
    assert seqs["s"] == whole and seqs["t"] == genome(300, 4) + "NNN" + genome(300, 5)
    lines = [r.value for r in out["text"].collect() if r.value.startswith(">s")][0].split("\n")
    assert "".join(lines[1:]) == whole and max(map(len, lines[1:])) == 60


def test_contigs(spark):
    rows = gap_close.contigs(spark.createDataFrame([(0, "NNACnGTTNN")], "scaffold_id long, seq string")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.pre_gap, r.seq, r.start) for r in rows] == [(0, 2, "AC", 2), (1, 1, "GTT", 5)]


def test_misleading_reads_are_dropped(spark):
    chain = spark.createDataFrame([(0, 0, 0), (1, 0, 1), (9, 5, 0)], "contig_id long, scaffold_id long, ordinal int")
    schema = "read_id long, node long, contig_id long, reverse boolean, anchors long, left_read long, right_read long, left_contig long, right_contig long"
    of = lambda weight: spark.createDataFrame([(1, 0, 0, False, 500, 0, 9, 0, 9), (1, 1, 9, False, weight, 0, 9, 0, 9), (1, 2, 1, False, 300, 0, 9, 0, 9)], schema)
    assert [r.contig_id for r in gap_close.extended(of(99), chain).orderBy("node").collect()] == [0, 1]
    assert gap_close.extended(of(100), chain).count() == 0


# streaming


@pytest.fixture
def stream(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i), i % 3, "ab"[i % 2], float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    for k in range(4):
        df.where(F.floor(F.col("event_id") / 25) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return df, events.read_stream(spark, f"{tmp_path}/in", df.schema)


@pytest.mark.parametrize("make", [events.tumbling, events.sliding, lambda df: events.sessions(df, "2 hours")])
def test_stream_gives_the_rows_of_the_table(spark, stream, tmp_path, make):
    batch, live = stream
    query = events.to_table(make(live), f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select(*make(batch).columns).collect()))
    want = sorted(map(tuple, make(batch).collect()))
    # windows that the watermark hasn't passed are still open
    assert set(got) <= set(want) and len(got) >= len(want) * 0.3


def test_once(spark, stream, tmp_path):
    batch, live = stream
    twice = live.union(live)
    query = events.to_table(events.once(twice, "event_id"), f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination(120)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(100))
    assert events.once(batch.union(batch), "event_id").count() == 100
