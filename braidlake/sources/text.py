"""Readers of sequence text formats, on Spark's own scans, so that any store works and large files are split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidlake.functions import numeric as N
from braidlake.functions import sequence as S
from braidlake.runtime import map_arrow

RECORDS = "path string, block_start long, ordinal long, name string, seq string, qual string, tail boolean, lines array<string>"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four-line records of each file block; what a block's edges cut off is passed on as lines.

    In a block that doesn't begin a file, the first header is the first line with '@' two lines before one with
    '+': a quality line may begin with '@', but a sequence never begins with '+'. The lines before it end a record
    of an earlier block; those after the last whole record (the tail) begin one that a later block ends.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string())]
    key, held, ordinal, phased = None, [], 0, False
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)
        out.clear()
        return batch

    def cut_off(lines: list[str], tail: bool) -> None:
        if lines:
            out.append((*key, None, None, None, None, tail, list(lines)))

    for batch in batches:
        for path, start, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (path, start) != key:
                cut_off(held, phased)
                key, held, ordinal, phased = (path, start), [], 0, start == 0
            held.append(value.rstrip("\r"))
            if not phased and len(held) >= 3 and held[-3].startswith("@") and held[-1].startswith("+"):
                cut_off(held[:-3], False)
                held, phased = held[-3:], True
            if phased and len(held) == 4:
                out.append((path, start, ordinal, held[0][1:], held[1], held[3], None, None))
                held, ordinal = [], ordinal + 1
        yield flush()
    cut_off(held, phased)
    yield flush()


def fastq(spark: SparkSession, *paths: str) -> DataFrame:
    """path, block_start, ordinal, name, seq, qual of FASTQ files, compressed or not.

    Records are in the order (path, block_start, ordinal). Compressed files are one block each. A record cut by
    blocks is put together from its lines: a tail and the lines of blocks up to the next tail.
    """
    scanned = spark.read.text(list(paths)).select("_metadata.file_path", F.col("_metadata.file_block_start").alias("start"), "value")
    rows = map_arrow(scanned, _records, RECORDS)
    whole = rows.where("tail is null").drop("tail", "lines")
    # at most two rows a block
    order = Window.partitionBy("path").orderBy("block_start", "tail")
    parts = rows.where("tail is not null").withColumn("run", F.sum(F.col("tail").cast("int")).over(order))
    lines = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block_start", "tail", "lines"))), lambda x: x["lines"]))
    joined = parts.groupBy("path", "run").agg(F.min("block_start").alias("block_start"), lines.alias("l"))
    each = joined.where(F.size("l") >= 4).select("path", "block_start", "l", F.explode(F.sequence(F.lit(0), F.floor(F.size("l") / 4) - 1)).alias("i"))
    at = lambda k: F.element_at("l", (4 * F.col("i") + k).cast("int"))
    cut = each.select("path", "block_start", ((1 << 40) + F.col("i")).alias("ordinal"), F.substr(at(1), F.lit(2)).alias("name"), at(2).alias("seq"), at(4).alias("qual"))
    return whole.unionByName(cut)


def barcode_of_header(name: str = "name"):
    """What stands after the last '#' and before '/' of a read's name."""
    return F.substring_index(F.substring_index(F.col(name), "#", -1), "/", 1)


def barcoded_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Read pairs with the barcode of their headers: pair_id, name, barcode, barcode_id, seq1, quals1, seq2, quals2.

    Mates are joined by name, and must carry the same barcode; a read without its mate is an error. Bases that weren't called become A. pair_id follows
    the order of the first file.
    """

    def mates(path: str, n: int) -> DataFrame:
        rows = fastq(spark, path).withColumns({"barcode": barcode_of_header(), "id": F.substring_index("name", "/", 1)})
        return rows.select("id", F.col("barcode").alias(f"barcode{n}"), S.n_to_a("seq").alias(f"seq{n}"), S.phred("qual").alias(f"quals{n}"), F.struct("block_start", "ordinal").alias(f"at{n}"))

    both = mates(first, 1).join(mates(second, 2), "id", "full")
    checked = both.where(F.assert_true(F.col("barcode1") == F.col("barcode2"), F.lit("mates with different barcodes, or a read without its mate")).isNull())
    return checked.select(F.xxhash64("id").alias("pair_id"), F.col("id").alias("name"), F.col("barcode1").alias("barcode"), S.barcode_id("barcode1").alias("barcode_id"), "seq1", "quals1", "seq2", "quals2", F.col("at1").alias("at"))


def fasta(spark: SparkSession, *paths: str) -> DataFrame:
    """name (up to the first blank), description, seq and length. Records may have any number of lines."""
    rows = spark.read.text(list(paths), lineSep="\n>").select(F.regexp_replace("value", "\r", "").alias("v")).where("length(trim(v)) > 0")
    head = F.regexp_replace(F.substring_index("v", "\n", 1), "^>", "")
    body = F.when(F.locate("\n", F.col("v")) > 0, F.regexp_replace(F.expr("substr(v, locate('\n', v) + 1)"), "\\s", "")).otherwise("")
    return rows.select(F.regexp_extract(head, "^(\\S*)", 1).alias("name"), head.alias("description"), body.alias("seq")).withColumn("length", F.length("seq"))


def check_names(found: DataFrame, header: DataFrame) -> DataFrame:
    """Sequences whose name is missing from a header or whose length differs. Both: name, length."""
    return found.select("name", F.col("length").alias("found")).join(header.select("name", F.col("length").alias("expected")), "name", "full").where("not found <=> expected")


PAF = ("q string", "qlen int", "qs int", "qe int", "strand string", "t string", "tlen int", "ts int", "te int", "nmatch int", "alen int", "mapq int", "tag1 string")


def paf(spark: SparkSession, *paths: str) -> DataFrame:
    """The twelve columns of pairwise alignments and the first tag."""
    parts = F.split(F.trim("value"), "\\s+")
    return spark.read.text(list(paths)).where("length(trim(value)) > 0").select(*[F.get(parts, i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(x.split() for x in PAF)])


def sam(spark: SparkSession, *paths: str) -> DataFrame:
    """Alignments of SAM text: the eleven columns (pos from 0), end on the reference, flags as booleans, barcode tag, tags."""
    parts = F.split("value", "\t")
    names = ("qname string", "flag int", "rname string", "pos1 int", "mapq int", "cigar string", "rnext string", "pnext1 int", "tlen int", "seq string", "qual string")
    rows = spark.read.text(list(paths)).where("value <> '' and not startswith(value, '@')").select(
        *[F.get(parts, i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(x.split() for x in names)], F.slice(parts, 12, 10_000).alias("tags")
    )
    return with_flags(rows.withColumns({"pos": F.col("pos1") - 1, "mate_pos": F.col("pnext1") - 1, "mate_rname": F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext"))}).drop("pos1", "pnext1", "rnext"))


FLAGS = {"paired": 0x1, "proper": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8, "is_reverse": 0x10, "mate_reverse": 0x20, "is_read1": 0x40, "is_read2": 0x80, "secondary": 0x100, "failed": 0x200, "duplicate": 0x400, "supplementary": 0x800}


def with_flags(rows: DataFrame) -> DataFrame:
    """Flags as booleans, the alignment's end, and the barcode from its tag or name."""
    bits = {name: F.col("flag").bitwiseAND(bit) != 0 for name, bit in FLAGS.items()}
    tag = F.element_at(F.filter("tags", lambda t: t.startswith("BX:Z:")), 1)
    with_end = rows.withColumns(bits | {"aend": F.col("pos") + F.coalesce(N.reference_length("cigar"), F.lit(0))})
    named = F.when(F.size(F.filter("tags", lambda t: t.startswith("BX:Z:"))) > 0, F.substr(tag, F.lit(6))).when(F.col("qname").contains("#"), barcode_of_header("qname"))
    return with_end.withColumn("barcode", named)


def sam_header(spark: SparkSession, *paths: str) -> DataFrame:
    """name, length and place of the reference sequences of SAM headers."""
    rows = spark.read.text(list(paths)).where("startswith(value, '@SQ')")
    return rows.select(F.regexp_extract("value", "\tSN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", "\tLN:([0-9]+)", 1).cast("int").alias("length"))


#: unmapped, secondary, failed, duplicate, supplementary
UNUSED = 0x4 | 0x100 | 0x200 | 0x400 | 0x800


def barcode_points(alignments: DataFrame, least: int = 60) -> DataFrame:
    """scaffold, pos (the alignment's middle) and barcode of reads that are placed well and have a barcode."""
    good = alignments.where((F.col("mapq") >= least) & (F.col("flag").bitwiseAND(UNUSED) == 0) & F.col("barcode").isNotNull() & ~F.col("barcode").isin("0", "0_0_0"))
    return good.select(F.col("rname").alias("scaffold"), N.midpoint("pos", "aend").alias("pos"), "barcode")


def point_counts(alignments: DataFrame, least: int = 60) -> DataFrame:
    """How many alignments are used, of low quality, duplicates, or other, for each scaffold."""
    kind = F.when(F.col("duplicate"), "duplicate").when(F.col("mapq") < least, "low").when(F.col("flag").bitwiseAND(UNUSED) != 0, "other").otherwise("used")
    per = alignments.select("rname", kind.alias("kind"))
    return per.groupBy("rname").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("used", "low", "duplicate", "other")])


def bed(spark: SparkSession, *paths: str) -> DataFrame:
    parts = F.split("value", "\t")
    rows = spark.read.text(list(paths)).where("value <> '' and not value rlike '^(#|track|browser)'")
    return rows.select(F.get(parts, 0).alias("chrom"), F.get(parts, 1).cast("int").alias("start"), F.get(parts, 2).cast("int").alias("stop"), F.get(parts, 3).alias("name"))


def gff(spark: SparkSession, *paths: str) -> DataFrame:
    """Features with half-open intervals from 0 and attributes as a map."""
    parts = F.split("value", "\t")
    rows = spark.read.text(list(paths)).where("value <> '' and not startswith(value, '#')")
    attributes = F.str_to_map(F.get(parts, 8), F.lit(";"), F.lit("="))
    return rows.select(
        F.get(parts, 0).alias("chrom"), F.get(parts, 1).alias("source"), F.get(parts, 2).alias("type"), (F.get(parts, 3).cast("int") - 1).alias("start"), F.get(parts, 4).cast("int").alias("stop"),
        F.get(parts, 6).alias("strand"), attributes.alias("attributes"),
    )


def vcf(spark: SparkSession, *paths: str) -> DataFrame:
    """Variants: pos from 0, alternatives as an array, info as a map, samples as an array of maps by format key."""
    parts = F.split("value", "\t")
    rows = spark.read.text(list(paths)).where("value <> '' and not startswith(value, '#')")
    keys = F.split(F.get(parts, 8), ":")
    samples = F.transform(F.slice(parts, 10, 100_000), lambda s: F.map_from_entries(F.arrays_zip(keys, F.slice(F.concat(F.split(s, ":"), F.array_repeat(F.lit("."), F.size(keys))), F.lit(1), F.size(keys)))))
    return rows.select(
        F.get(parts, 0).alias("chrom"), (F.get(parts, 1).cast("int") - 1).alias("pos"), F.get(parts, 2).alias("id"), F.get(parts, 3).alias("ref"), F.split(F.get(parts, 4), ",").alias("alt"),
        F.get(parts, 5).try_cast("double").alias("qual"), F.get(parts, 6).alias("filter"), F.str_to_map(F.get(parts, 7), F.lit(";"), F.lit("=")).alias("info"), F.when(F.size(parts) > 9, samples).alias("samples"),
    )


def region(rows: DataFrame, chrom: str, start: int, stop: int) -> DataFrame:
    """Rows (chrom, start, stop) that overlap a region."""
    return rows.where((F.col("chrom") == chrom) & (F.col("start") < stop) & (F.col("stop") > start))


def extract_reads(spark: SparkSession, *paths: str, fraction: float = 1.0, chrom: str | None = None, start: int = 0, stop: int = 1 << 30) -> DataFrame:
    """name, seq, qual of reads of FASTQ, FASTA, SAM or BAM files, told by their endings.

    A fraction is taken by hash of the name, so mates stay together. A region keeps aligned reads that overlap it.
    """
    from .bam import bam

    parts = []
    for path in paths:
        kind = path.removesuffix(".gz").rpartition(".")[2].lower()
        if kind in ("fq", "fastq"):
            rows = fastq(spark, path).select("name", "seq", "qual")
        elif kind in ("fa", "fasta"):
            rows = fasta(spark, path).select("name", "seq", F.lit(None).cast("string").alias("qual"))
        elif kind in ("sam", "bam"):
            rows = sam(spark, path) if kind == "sam" else bam(spark, path)
            if chrom is not None:
                rows = rows.where((F.col("rname") == chrom) & (F.col("pos") < stop) & (F.col("aend") > start))
            turned = lambda c, other: F.when(F.col("is_reverse"), other).otherwise(F.col(c))
            rows = rows.where(~F.col("secondary") & ~F.col("supplementary")).select(F.col("qname").alias("name"), turned("seq", S.reverse_complement("seq")).alias("seq"), turned("qual", F.reverse("qual")).alias("qual"))
        else:
            raise ValueError(f"no reads in {path}")
        parts.append(rows)
    out = parts[0]
    for rows in parts[1:]:
        out = out.unionByName(rows)
    base = F.substring_index("name", "/", 1)
    return out if fraction >= 1 else out.where(F.pmod(F.xxhash64(base), F.lit(1_000_000)) < int(fraction * 1_000_000))
