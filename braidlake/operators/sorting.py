"""Orders, buckets and samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.runtime import map_arrow


def sort_permutation(df: DataFrame, *order: str, by: Sequence[str] = (), name: str = "place") -> DataFrame:
    """The place (from 0) that each row takes when its group is sorted."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def bucket_by_prefix(reads: DataFrame, barcode: str = "barcode_seq", letters: int = 2, tie: str = "qname") -> DataFrame:
    """Reads in buckets of barcode prefixes, sorted by barcode and name; those without a barcode apart, first.

    As many buckets as there are prefixes; a bucket's rows are sorted where they are.
    """
    prefix = F.coalesce(F.substring(barcode, 1, letters), F.lit(""))
    return reads.withColumn("bucket", prefix).repartition(4**letters + 1, "bucket").sortWithinPartitions("bucket", F.col(barcode).asc_nulls_first(), tie)


def bucket_by_range(rows: DataFrame, buckets: int, *order: str) -> DataFrame:
    """Rows in ranges of their keys, sorted; equal keys are never parted. bucket is the range's number.

    Bounds come from a sample, as in a range-partitioned sort.
    """
    placed = rows.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    return placed.withColumn("bucket", F.spark_partition_id())


def bucket_by_hash(rows: DataFrame, buckets: int, *key: str) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def barcode_order(reads: DataFrame, barcode: str = "barcode") -> DataFrame:
    """Barcode-sorted reads: those without (0) first and in input order, then each barcode's pairs in descending order.

    reads: read_id, barcode, seq1, seq2. The order of barcodes is that of their numbers.
    """
    coded = F.col(barcode) != 0
    return reads.orderBy(
        barcode, F.when(~coded, F.col("read_id")), F.when(coded, F.col("seq1")).desc_nulls_last(), F.when(coded, F.col("seq2")).desc_nulls_last(), "read_id"
    )


def balanced_buckets(lines: DataFrame, size: int = 1_000_000, length: str = "length", name: str = "line", least: int = 0) -> DataFrame:
    """Lines from long to short, ties by name, in buckets that are closed once their content reaches ``size``.

    Lines shorter than ``least`` go into none and have no row. Only a histogram of the lengths is walked in order, in
    one task: of each length so many lines complete the open bucket, and then every bucket takes as many.
    """
    kept = lines.where(F.col(length) >= least)
    per = kept.groupBy(F.col(length).cast("long").alias("_len")).agg(F.count("*").alias("_n"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, filled = 0, 0  # the open bucket and its content
        for batch in batches:
            out = []
            for at, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # lines without length never complete a bucket
                each = -(-size // at) if at > 0 else n + 1
                room = -(-(size - filled) // at) if at > 0 else n + 1
                out.append((at, bucket, room, each))
                rest = n - room
                if rest < 0:
                    filled += n * at
                else:
                    whole, left = divmod(rest, each)
                    bucket, filled = bucket + 1 + whole, left * at
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["_len", "_open", "_room", "_each"])

    ordered = per.repartition(1).sortWithinPartitions(F.desc("_len"))
    marked = map_arrow(ordered, walk, "_len long, _open long, _room long, _each long")
    rank = F.row_number().over(Window.partitionBy(length).orderBy(name)) - 1
    placed = kept.withColumn("_rank", rank).join(marked, F.col(length).cast("long") == F.col("_len"))
    later = F.col("_open") + 1 + F.floor((F.col("_rank") - F.col("_room")) / F.col("_each"))
    return placed.withColumn("bucket", F.when(F.col("_rank") < F.col("_room"), F.col("_open")).otherwise(later).cast("long")).drop("_rank", "_len", "_open", "_room", "_each")


def top(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def sample_pairs(reads: DataFrame, rate: float, pair: str = "pair_id", seed: int = 0) -> DataFrame:
    """Both mates of a share of the pairs, chosen by hash: reruns and any order of rows give the same."""
    return reads.where(F.pmod(F.xxhash64(F.lit(seed), pair), F.lit(1_000_000)) < int(rate * 1_000_000))


def sample_exactly(reads: DataFrame, pairs: int, pair: str = "pair_id", seed: int = 0) -> DataFrame:
    """Both mates of exactly so many pairs (all, if there are fewer): those of the smallest hashes."""
    ids = reads.select(pair).distinct()
    return reads.join(ids.orderBy(F.xxhash64(F.lit(seed), pair), pair).limit(pairs), pair, "left_semi")


def sampling_rate(estimated: float, gigabases: float | None = None, rate: float | None = None, reads: float | None = None, bases_per_read: float = 1.0) -> float:
    """The rate that one of three requests asks for, at most 1."""
    given = [x is not None for x in (gigabases, rate, reads)]
    if sum(given) > 1:
        raise ValueError("ask for gigabases, a rate or a number of reads")
    if rate is not None:
        return min(1.0, rate)
    wanted = gigabases * 1e9 if gigabases is not None else reads * bases_per_read if reads is not None else estimated
    return min(1.0, wanted / estimated) if estimated > 0 else 1.0


def max_per_group(rows: DataFrame, by: Sequence[str], cap: int) -> DataFrame:
    """Rows of groups with fewer than ``cap`` rows; larger groups go as a whole."""
    few = rows.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") < cap).drop("_n")
    return rows.join(few, list(by), "left_semi")
