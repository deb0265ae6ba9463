"""N50 and its relatives.

Values are counted before anything is ordered: what a window sorts is one row a distinct value, so neither a hot
group nor repeated values weigh on one task, and partial counts are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """v and c: each distinct value of a group and how often it occurs; nulls don't count."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))


def _groups(by: Sequence[str]) -> list[Column]:
    return [F.col(b) for b in by] or [F.lit(0)]


def n50(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "n50") -> DataFrame:
    """The least value so that it and the smaller ones make up half of the sum.

    If they make up exactly half, the integer mean of it and the next value. Values are positive; a group without
    any has no row.
    """
    ascending = Window.partitionBy(*_groups(by)).orderBy("v")
    whole = Window.partitionBy(*_groups(by))
    rows = histogram(df, value, by).withColumns(
        {"upto": F.sum(F.col("v") * F.col("c")).over(ascending), "next": F.lead("v").over(ascending), "total": F.sum(F.col("v") * F.col("c")).over(whole)}
    )
    half = F.when((2 * F.col("upto") == F.col("total")) & F.col("next").isNotNull(), F.expr("cast(v + next as bigint) div 2")).otherwise(F.col("v"))
    return rows.where(2 * F.col("upto") >= F.col("total")).groupBy(*by).agg(F.min_by(half, "v").cast("long").alias(name))


def n_levels(df: DataFrame, value: str, by: Sequence[str] = (), levels: Sequence[int] = (10, 20, 30, 40, 50, 60, 70, 80, 90)) -> DataFrame:
    """level and n for each level: with every value repeated as often as it says, from large to small, the one at
    position (sum * level) div 100, counted from 0."""
    descending = Window.partitionBy(*_groups(by)).orderBy(F.desc("v"))
    whole = Window.partitionBy(*_groups(by))
    rows = histogram(df, value, by).withColumns({"upto": F.sum(F.col("v") * F.col("c")).over(descending), "total": F.sum(F.col("v") * F.col("c")).over(whole)})
    asked = rows.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    place = F.floor(F.col("total") * F.col("level") / 100)
    return asked.where(F.col("upto") > place).groupBy(*by, "level").agg(F.max("v").cast("long").alias("n"))


def n_linear(df: DataFrame, value: str, fraction: float = 0.5, by: Sequence[str] = (), name: str = "n50pl") -> DataFrame:
    """N50 on the line through the points (share of the sum up to an element, element), instead of the steps.

    Equal values are elements of their own, so between two of them the line is flat; before the first it comes from 0.
    Of integers the result is one, cut off. Values are positive.
    """
    ascending = Window.partitionBy(*_groups(by)).orderBy("v")
    whole = Window.partitionBy(*_groups(by))
    rows = histogram(df, value, by).withColumns(
        {"upto": F.sum(F.col("v") * F.col("c")).over(ascending), "last": F.lag("v").over(ascending), "total": F.sum(F.col("v") * F.col("c")).over(whole)}
    )
    goal = F.col("total") * fraction
    before = F.col("upto") - F.col("v") * F.col("c")
    element = F.greatest(F.lit(0), F.ceil((goal - before) / F.col("v")) - 1)
    low = F.when(element > 0, F.col("v")).otherwise(F.coalesce("last", F.lit(0)))
    share = (goal - before - element * F.col("v")) / F.col("v")
    at = (1 - share) * low + share * F.col("v")
    if isinstance(df.schema[value].dataType, T.IntegralType):
        at = at.cast("long")
    return rows.where(F.col("upto") >= goal).groupBy(*by).agg(F.min_by(at, "v").alias(name))


def weighted_mean(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "weighted_mean") -> DataFrame:
    """Mean of the values, each weighted by itself."""
    return df.groupBy(*by).agg(F.try_divide(F.sum(F.col(value) * F.col(value)), F.sum(value)).alias(name))


def binned_weighted_mean(df: DataFrame, value: str, width: int, by: Sequence[str] = (), name: str = "weighted_mean") -> DataFrame:
    """The same from bins, each value standing in for its bin's middle."""
    middle = (F.floor(F.col(value) / width) + 0.5) * width
    return weighted_mean(df.withColumn("_middle", middle), "_middle", by, name)


def spread(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """mean and population deviation."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))


def upper_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """The value at position n div 2 of the sorted values, counted from 0; no averaging."""
    ascending = Window.partitionBy(*_groups(by)).orderBy("v")
    rows = histogram(df, value, by).withColumns({"upto": F.sum("c").over(ascending), "total": F.sum("c").over(Window.partitionBy(*_groups(by)))})
    return rows.where(F.col("upto") > F.floor(F.col("total") / 2)).groupBy(*by).agg(F.min("v").alias(name))


def quantiles(df: DataFrame, value: str, levels: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """level and q: the least value whose share of values up to it reaches the level."""
    ascending = Window.partitionBy(*_groups(by)).orderBy("v")
    rows = histogram(df, value, by).withColumns({"upto": F.sum("c").over(ascending), "total": F.sum("c").over(Window.partitionBy(*_groups(by)))})
    asked = rows.withColumn("level", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    return asked.where(F.col("upto") >= F.col("level") * F.col("total")).groupBy(*by, "level").agg(F.min("v").alias("q"))


def cumulative(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """v, c, upto and share: the distribution function over distinct values."""
    ascending = Window.partitionBy(*_groups(by)).orderBy("v")
    rows = histogram(df, value, by).withColumn("upto", F.sum("c").over(ascending))
    return rows.withColumn("share", F.col("upto") / F.sum("c").over(Window.partitionBy(*_groups(by))))
