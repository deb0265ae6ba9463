import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from braidlake.sources import bam, sinks, text


def reads(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randint(1, 60)
        out.append((f"r{i}#1_2_{i % 5}/1", "".join(rng.choice("ACGTN") for _ in range(k)), "".join(rng.choice("@+#I>") for _ in range(k))))
    return out


def as_fastq(rows, end="\n"):
    return "".join(f"@{n}{end}{s}{end}+{end}{q}{end}" for n, s, q in rows)


@pytest.mark.parametrize("size", ["64", "150", "1000", "100000"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_of_split_files(spark, tmp_path, size, end):
    """Files are cut into small blocks, within names, qualities that begin with '@', and line ends."""
    rows = reads(60)
    (tmp_path / "a.fq").write_bytes(as_fastq(rows, end).encode())
    (tmp_path / "b.fq.gz").write_bytes(gzip.compress(as_fastq(rows[:7]).encode()))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = text.fastq(spark, f"file://{tmp_path}/a.fq", f"file://{tmp_path}/b.fq.gz").orderBy("path", "block_start", "ordinal").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.name, r.seq, r.qual) for r in got) == sorted(rows + rows[:7])
    if size == "100000":
        assert [r.name for r in got] == [r[0] for r in rows + rows[:7]]


def test_barcoded_pairs(spark, tmp_path):
    rows = reads(20)
    (tmp_path / "1.fq").write_text(as_fastq(rows))
    (tmp_path / "2.fq").write_text(as_fastq([(n[:-1] + "2", s[::-1], q[::-1]) for n, s, q in rows]))
    got = {r.name: r for r in text.barcoded_pairs(spark, f"{tmp_path}/1.fq", f"{tmp_path}/2.fq").collect()}
    for n, s, q in rows:
        r = got[n[:-2]]
        assert (r.barcode, r.barcode_id) == (n.split("#")[1][:-2], 1537 * 1537 + 2 * 1537 + int(n[-3]))
        assert r.seq1 == s.replace("N", "A") and r.quals1 == [ord(c) - 33 for c in q] and r.seq2 == r.seq1[::-1]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACGT\nAC\n\n>two\n>three x\r\nNNA\r\nC\r\n")
    rows = text.fasta(spark, f"{tmp_path}/a.fa").orderBy("name").collect()
    assert [(r.name, r.description, r.seq, r.length) for r in rows] == [("one", "one first", "ACGTAC", 6), ("three", "three x", "NNAC", 4), ("two", "two", "", 0)]
    header = spark.createDataFrame([("one", 6), ("two", 1), ("four", 2)], "name string, length int")
    assert {r.name for r in text.check_names(text.fasta(spark, f"{tmp_path}/a.fa"), header).collect()} == {"two", "three", "four"}


SAM = """@HD\tVN:1.6
@SQ\tSN:s1\tLN:1000
@SQ\tSN:s2\tLN:50
r1#1_1_1\t99\ts1\t11\t60\t5M2I3D5M\t=\t101\t150\tACGTACGTACGT\tIIIIIIIIIIII\tNM:i:1
r2#0_0_0\t0\ts1\t21\t60\t10M\t*\t0\t0\tACGTACGTAC\t*
r3\t1024\ts1\t31\t60\t10M\t*\t0\t0\tACGTACGTAC\t*\tBX:Z:7_7_7
r4\t0\ts2\t1\t5\t10M\t*\t0\t0\tACGTACGTAC\t*\tBX:Z:7_7_7
r5\t0\ts2\t1\t60\t10M\t*\t0\t0\tACGTACGTAC\t*\tXX:i:3\tBX:Z:8_8_8
"""


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    rows = text.sam(spark, f"{tmp_path}/a.sam")
    first = rows.where("qname like 'r1%'").first()
    assert (first.pos, first.aend, first.mate_pos, first.mate_rname, first.barcode) == (10, 23, 100, "s1", "1_1_1")
    assert first.is_read1 and first.mate_reverse and not first.is_reverse
    assert sorted(map(tuple, text.barcode_points(rows).collect())) == [("s1", 16, "1_1_1"), ("s2", 5, "8_8_8")]
    assert sorted(map(tuple, text.point_counts(rows).collect())) == [("s1", 2, 0, 1, 0), ("s2", 1, 1, 0, 0)]
    assert sorted(map(tuple, text.sam_header(spark, f"{tmp_path}/a.sam").collect())) == [("s1", 1000), ("s2", 50)]


def bgzf(data, size=100):
    out = b""
    for at in range(0, len(data), size):
        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += engine.compress(data[at : at + size]) + engine.flush()
    return out


def bam_record(name, flag, tid, pos, mapq, cigar, seq, tags):
    codes = [(n << 4) | bam.CIGAR.index(k) for n, k in cigar]
    packed = bytes((bam.BASES.index(seq[i]) << 4) | (bam.BASES.index(seq[i + 1]) if i + 1 < len(seq) else 0) for i in range(0, len(seq), 2))
    body = struct.pack("<iiBBHHHiiii", tid, pos, len(name) + 1, mapq, 0, len(codes), flag, len(seq), -1, -1, 0)
    body += name.encode() + b"\0" + struct.pack(f"<{len(codes)}I", *codes) + packed + bytes([40] * len(seq)) + tags
    return struct.pack("<i", len(body)) + body


def test_bam(spark, tmp_path):
    names = [("s1", 1000), ("s2", 50)]
    data = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2)
    for n, length in names:
        data += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length)
    tags = b"NMi" + struct.pack("<i", -3) + b"BXZ1_2_3\0" + b"XAAq" + b"XBBs" + struct.pack("<ihh", 2, 5, -6) + b"XFf" + struct.pack("<f", 0.5)
    for i in range(50):
        data += bam_record(f"r{i}", 16 * (i % 2), i % 2, i, 60, [(3, "M"), (1, "D"), (2, "S")], "ACGTN"[: 5], tags)
    (tmp_path / "a.bam").write_bytes(bgzf(data))
    rows = bam.bam(spark, f"{tmp_path}/a.bam").orderBy("pos").collect()
    assert len(rows) == 50
    r = rows[3]
    assert (r.qname, r.rname, r.pos, r.cigar, r.seq, r.qual, r.aend, r.is_reverse, r.barcode) == ("r3", "s2", 3, "3M1D2S", "ACGTN", "IIIII", 7, True, "1_2_3")
    assert r.tags == ["NM:i:-3", "BX:Z:1_2_3", "XA:A:q", "XB:B:s,5,-6", "XF:f:0.5"]


def test_paf_bed_gff_vcf(spark, tmp_path):
    (tmp_path / "a.paf").write_text("q1\t100\t0\t95\t+\tt1\t900\t5\t100\t90\t95\t60\ttp:A:P\tcm:i:9\nq2 50 0 9 - t1 900 1 10 9 9 0\n")
    rows = text.paf(spark, f"{tmp_path}/a.paf").orderBy("q").collect()
    assert (rows[0].alen, rows[0].tag1, rows[1].strand, rows[1].tag1) == (95, "tp:A:P", "-", None)
    (tmp_path / "a.bed").write_text("#x\nchr1\t5\t9\tg\nchr2\t1\t2\n")
    assert [tuple(r) for r in text.region(text.bed(spark, f"{tmp_path}/a.bed"), "chr1", 8, 20).collect()] == [("chr1", 5, 9, "g")]
    (tmp_path / "a.gff").write_text("##gff\nchr1\ts\tgene\t6\t9\t.\t+\t.\tID=a;Name=b\n")
    g = text.gff(spark, f"{tmp_path}/a.gff").first()
    assert (g.start, g.stop, g.attributes) == (5, 9, {"ID": "a", "Name": "b"})
    (tmp_path / "a.vcf").write_text("##f\n#CHROM\tPOS\nchr1\t10\trs1\tA\tC,G\t50\tPASS\tDP=9;DB\tGT:DP\t0/1:7\t1/1\n")
    v = text.vcf(spark, f"{tmp_path}/a.vcf").first()
    assert (v.pos, v.alt, v.qual, v.info["DP"]) == (9, ["C", "G"], 50.0, "9")
    assert v.samples == [{"GT": "0/1", "DP": "7"}, {"GT": "1/1", "DP": "."}]


def test_written_text_reads_back(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ACGT" * 300), ("b", "AC")], "name string, seq string")
    sinks.write_text(sinks.fasta_text(rows), f"{tmp_path}/out")
    back = text.fasta(spark, f"{tmp_path}/out").collect()
    assert [(r.name, r.seq) for r in back] == [("a", "ACGT" * 300)]
    lines = sinks.fasta_text(rows).first().value.split("\n")
    assert max(map(len, lines)) == 80 and len(lines) == 16


def test_scaffold_text(spark):
    parts = spark.createDataFrame([(0, 0, "x", "ACC", False, 0), (0, 1, "y", "TTG", True, 3), (5, 0, "z", "G", False, 0)], "chain long, ordinal long, name string, seq string, reversed boolean, gap long")
    got = sorted(r.value for r in sinks.scaffold_text(parts).collect())
    assert got == [">0 x + 3 N + y\nACCNNNCAA", ">5 z\nG"]
    with pytest.raises(Exception, match="gap without"):
        sinks.scaffold_text(parts.withColumn("gap", F.lit(-1))).collect()


def test_haplotypes_and_flavours(spark):
    shared = spark.createDataFrame([("a", "AA"), ("b", "CC")], "name string, seq string")
    alleles = spark.createDataFrame([("a", 1, "GG"), ("a", 2, "TT")], "name string, allele int, seq string")
    assert sorted(map(tuple, sinks.haplotype_sequences(shared, alleles).collect())) == [("a", 1, "GG"), ("a", 2, "TT"), ("b", 1, "CC"), ("b", 2, "CC")]
    cells = spark.createDataFrame([(1, 0, 0, 1, "A"), (1, 1, 0, 3, "C"), (1, 1, 1, 9, "G"), (1, 2, 0, 1, "T")], "line int, cell int, branch int, support int, seq string")
    of = lambda f: sorted(map(tuple, sinks.line_flavours(cells, f).collect()))
    assert of("pseudohap") == [("1", "AGT")] and of("pseudohap2") == [("1_1", "AGT"), ("1_2", "ACT")]
    assert len(of("raw")) == 4 and sorted(s for _, s in of("megabubbles")) == ["A", "C", "G", "T"]


def test_metric_sinks(spark):
    import json

    rows = spark.createDataFrame([("a", "INT", "3", "an a", True), ("b", "DOUBLE", "2.5", "a b", False), ("c", "STRING", 'x"y', "a c", True)], "name string, type string, value string, gloss string, cs boolean")
    assert json.loads(sinks.metrics_json(rows).first().value) == {"a": 3, "b": 2.5, "c": 'x"y'}
    assert json.loads(sinks.metrics_json(rows, True).first().value)["b"] == {"value": 2.5, "description": "a b"}
    assert sinks.metrics_csv(rows).first().asDict() == {"a": "3", "c": 'x"y'}
    assert sorted(r.value for r in sinks.metrics_text(rows).collect())[0] == "a 3"
    bins = spark.createDataFrame([(0.0, 2), (20.0, 5)], "bin double, n long")
    assert json.loads(sinks.histogram_json(bins, "d", "s", 10.0).first().value)["vals"] == [2, 0, 5]


def test_reads_of_several_formats(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM.replace("r4\t0", "r4\t16"))
    (tmp_path / "a.fa").write_text(">x y\nAC\nGT\n")
    (tmp_path / "a.fq").write_text(as_fastq(reads(30)))
    got = {r.name: (r.seq, r.qual) for r in text.extract_reads(spark, f"{tmp_path}/a.sam", f"{tmp_path}/a.fa", f"{tmp_path}/a.fq").collect()}
    assert len(got) == 36 and got["x"] == ("ACGT", None) and got["r4"][0] == "GTACGTACGT"
    near = text.extract_reads(spark, f"{tmp_path}/a.sam", chrom="s1", start=25, stop=31)
    assert sorted(r.name[:2] for r in near.collect()) == ["r2", "r3"]
    some = text.extract_reads(spark, f"{tmp_path}/a.fq", fraction=0.5).count()
    assert 5 < some < 25
    with pytest.raises(ValueError):
        text.extract_reads(spark, "a.txt")


def test_vcf_lines_read_back(spark, tmp_path):
    lines = ["chr1\t10\trs1\tA\tC,G\t50.0\tPASS\tDB;DP=9", "chr2\t1\t.\tT\tA\t.\t.\t."]
    (tmp_path / "a.vcf").write_text("##f\n" + "\n".join(lines) + "\n")
    written = sorted(r.value for r in sinks.vcf_text(text.vcf(spark, f"{tmp_path}/a.vcf")).collect())
    assert written == sorted(lines)
