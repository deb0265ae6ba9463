"""Structured Streaming over event rows. The reference data model has no streams: these are extensions.

Each function takes a streaming or a plain DataFrame with ts, user_id, event_type and value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total for each window; rows later than ``late`` are dropped by a stream."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "2 days", step: str = "1 day", late: str = "1 hour") -> DataFrame:
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width, step), "event_type").agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "1 day", late: str = "1 hour") -> DataFrame:
    """user_id, start, stop, n: runs of a user's events without a longer pause."""
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), "n")


def once(events: DataFrame, *key: str, late: str = "1 day") -> DataFrame:
    """The first row of each key; a stream forgets keys after ``late``."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(key)) if events.isStreaming else events.dropDuplicates(list(key))


def to_table(rows: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Start writing a stream as Parquet; what is available is processed and the query ends."""
    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
