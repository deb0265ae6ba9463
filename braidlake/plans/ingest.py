"""Barcode ingest: reads of two files, demultiplexed, trimmed, sorted by barcode and written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.functions import sequence as S
from braidlake.operators import dedup, joins, sorting
from braidlake.sources import text


def whitelist(spark: SparkSession, path: str) -> DataFrame:
    """segment and barcode_id of a list with one pair a line."""
    parts = F.split("value", "\\s+")
    return spark.read.text(path).where("trim(value) <> ''").select(F.get(parts, 0).alias("segment"), F.get(parts, 1).cast("int").alias("barcode_id"))


def demultiplexed(spark: SparkSession, first: str, second: str, segments: DataFrame, read_length: int, offsets: tuple[int, ...] = (0, 16, 32), width: int = 10) -> DataFrame:
    """Pairs whose second mate ends with the barcode's segments, after ``read_length`` bases.

    name, barcode (a_b_c), barcode_id, seq1, qual1, seq2, qual2; the second mate is cut to its read.
    """
    a = text.fastq(spark, first).select(F.substring_index("name", "/", 1).alias("name"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    b = text.fastq(spark, second).select(F.substring_index("name", "/", 1).alias("name"), "seq", F.col("qual").alias("qual2"))
    coded = joins.demultiplex(b, segments, "seq", read_length, offsets, width)
    cut = coded.select("name", "barcode", S.barcode_id("barcode").alias("barcode_id"), F.substring("seq", 1, read_length).alias("seq2"), F.substring("qual2", 1, read_length).alias("qual2"))
    return a.join(cut, "name")


def trimmed(pairs: DataFrame, first: int, second: int) -> DataFrame:
    """Pairs without the first bases of either mate."""
    return pairs.withColumns({f"{c}{n}": S.trim(f"{c}{n}", k) for n, k in ((1, first), (2, second)) for c in ("seq", "qual") if f"{c}{n}" in pairs.columns})


def barcode_sorted(pairs: DataFrame, cap: int | None = None) -> DataFrame:
    """Pairs in barcode order; barcodes with ``cap`` pairs or more are left out as a whole, those without stay."""
    kept = pairs
    if cap is not None:
        coded = sorting.max_per_group(pairs.where("barcode <> 0"), ["barcode"], cap)
        kept = coded.unionByName(pairs.where("barcode = 0"))
    return sorting.barcode_order(kept)


def merged(*parts: DataFrame) -> DataFrame:
    """Several barcode-sorted inputs as one: all reads without a barcode first, then the others by barcode."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("barcode", "read_id")


def run(spark: SparkSession, first: str, second: str, out: str, cap: int | None = None) -> DataFrame:
    """Read barcoded pairs, drop duplicates within barcodes, and write them sorted by barcode; returns what was written."""
    pairs = text.barcoded_pairs(spark, first, second).select("pair_id", "name", F.col("barcode_id").alias("barcode"), "seq1", "quals1", "seq2", "quals2", F.col("pair_id").alias("read_id"))
    barcode_sorted(dedup.predup(pairs), cap).write.parquet(out)
    return spark.read.parquet(out)


def preflight(arguments: dict) -> list[str]:
    """What is wrong with the arguments of a run; nothing, if it can start."""
    wrong = []
    for name in ("first", "second"):
        path = str(arguments.get(name) or "")
        if not path:
            wrong.append(f"{name} is missing")
        elif not ("://" in path or path.startswith("/")):
            wrong.append(f"{name} isn't an absolute path: {path}")
    pair = [str(arguments.get(n) or "").endswith(".gz") for n in ("first", "second")]
    if pair[0] != pair[1]:
        wrong.append("one input is compressed and the other isn't")
    if (length := arguments.get("barcode_length")) is not None and length not in (10, 16, 30):
        wrong.append(f"no barcode has {length} bases")
    if any(not isinstance(x, int) or x < 1 for x in arguments.get("lanes") or []):
        wrong.append("lanes are numbers from 1")
    if not all(c.isalnum() or c in "-_" for c in str(arguments.get("library") or "")):
        wrong.append("a library is named by letters, digits, - and _")
    if not 0 < float(arguments.get("rate", 1.0)) <= 1:
        wrong.append("the sampling rate lies in (0, 1]")
    return wrong


def chunks(files: DataFrame, pattern: str = r"_(?:si|S)[-_]?([A-Za-z0-9]+)_(?:lane[-_]?|L)(\d+)(?:_(R[12]|I[12]))?(?:_(?:chunk[-_])?(\d+))?") -> DataFrame:
    """Input files by sample index, lane and chunk: path, sample, lane, read, chunk. Both naming schemes are known:
    interleaved files (read ``RA`` before the index) and one file a mate (R1, R2)."""
    part = lambda i: F.regexp_extract("path", pattern, i)
    read = F.coalesce(F.nullif(F.regexp_extract("path", r"read[-_](RA|I1|I2)", 1), F.lit("")), F.nullif(part(3), F.lit("")))
    return files.where(F.col("path").rlike(pattern)).select("path", part(1).alias("sample"), part(2).cast("int").alias("lane"), read.alias("read"), F.nullif(part(4), F.lit("")).try_cast("int").alias("chunk"))


def estimated_reads(files: DataFrame, sample: DataFrame) -> DataFrame:
    """path, reads, bases that files are expected to hold, from the size of sampled records.

    files: path, bytes, compressed. sample: path, reads, bases, bytes (of text) of the first records. Of compressed
    files four fifths of the text's ratio count, as their ends compress better.
    """
    both = files.join(sample.withColumnRenamed("bytes", "text_bytes"), "path")
    factor = F.col("bytes") / F.col("text_bytes") * F.when(F.col("compressed"), 0.8).otherwise(1.0)
    return both.select("path", F.floor(F.col("reads") * factor).alias("reads"), F.floor(F.col("bases") * factor).alias("bases"))


def read_metrics(pairs: DataFrame) -> DataFrame:
    """Metrics of an ingest: name, value."""
    totals = pairs.agg(
        (2 * F.count("*")).cast("double").alias("reads"),
        F.sum(F.length("seq1") + F.length("seq2")).cast("double").alias("bases"),
        F.count_distinct(F.when(F.col("barcode") > 0, F.col("barcode"))).cast("double").alias("barcodes"),
        (100 * F.count_if(F.col("barcode") > 0) / F.count("*")).alias("valid_barcode_percent"),
    )
    return totals.select(F.explode(F.create_map(*[x for c in totals.columns for x in (F.lit(c), F.col(c))])).alias("name", "value"))


