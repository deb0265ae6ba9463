"""Aggregates over half-open intervals, by sweeping their ends.

Ends are counted before they are swept, so what a window orders is a row for each distinct position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def depth(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """start, stop, depth: stretches between neighbouring ends and how many intervals cover them (0 included)."""
    ends = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("d")))
    steps = spans.where("start < stop").select(*by, F.explode(ends).alias("e")).groupBy(*by, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy(*by).orderBy("at")
    rows = steps.select(*by, F.col("at").alias("start"), F.lead("at").over(order).alias("stop"), F.sum("d").over(order).alias("depth"))
    return rows.where("stop is not null")


def classes(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same with neighbouring stretches of equal depth joined."""
    rows = depth(spans, by)
    order = Window.partitionBy(*by).orderBy("start")
    new = F.coalesce((F.col("depth") != F.lag("depth").over(order)).cast("int"), F.lit(0))
    runs = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.first("depth").alias("depth")).drop("_run")


def merged(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """start, stop of the stretches that some interval covers; touching ones are one."""
    rows = depth(spans, by)
    order = Window.partitionBy(*by).orderBy("start")
    runs = rows.withColumn("_run", F.sum((F.col("depth") == 0).cast("int")).over(order)).where("depth > 0")
    return runs.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def covered(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """covered: positions in at least one interval."""
    return depth(spans, by).where("depth > 0").groupBy(*by).agg(F.sum(F.col("stop") - F.col("start")).alias("covered"))


def covered_at(spans: DataFrame, least: int, by: Sequence[str] = ()) -> DataFrame:
    """start, stop of the maximal stretches of at least this depth."""
    rows = depth(spans, by)
    order = Window.partitionBy(*by).orderBy("start")
    runs = rows.withColumn("_run", F.sum((F.col("depth") < least).cast("int")).over(order)).where(F.col("depth") >= least)
    return runs.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def uncovered(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """start, stop of the gaps between the first and the last interval."""
    return merged_gaps(depth(spans, by))


def merged_gaps(stretches: DataFrame) -> DataFrame:
    return stretches.where("depth = 0").drop("depth")


def span(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return spans.groupBy(*by).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
