"""Set algebra over rows and arrays, and reduction to maximal elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.runtime import materialize


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_distinct(*parts: DataFrame) -> DataFrame:
    return union_all(*parts).distinct()


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Rows of a whose key doesn't occur in b."""
    return a.join(b.select(*key).distinct(), list(key), "left_anti")


def members(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Rows of a whose key occurs in b."""
    return a.join(b, list(key), "left_semi")


def meet_size(a: Column, b: Column) -> Column:
    """Number of values that two arrays share."""
    return F.size(F.array_intersect(a, b))


def disjoint(a: Column, b: Column) -> Column:
    return ~F.arrays_overlap(a, b)


def jaccard(common: Column, a: Column, b: Column) -> Column:
    return common / (a + b - common)


def unique_with_partner(df: DataFrame, key: str, partner: Column) -> DataFrame:
    """One row a key, with the least partner."""
    return df.groupBy(key).agg(F.min(partner).alias("partner"))


def closure(edges: DataFrame, most: int = 40) -> DataFrame:
    """All (a, b) so that b can be reached from a, by squaring paths until none is new."""
    paths = materialize(edges.select("a", "b").where("a <> b").distinct(), "paths")
    count = paths.count()
    for _ in range(most):
        longer = paths.alias("p").join(paths.alias("q"), F.col("p.b") == F.col("q.a")).select(F.col("p.a").alias("a"), F.col("q.b").alias("b")).where("a <> b")
        paths = materialize(paths.unionByName(longer).distinct(), "paths")
        before, count = count, paths.count()
        if count == before:
            return paths
    raise RuntimeError("the closure did not settle")


def maximal(names: DataFrame, contained: DataFrame) -> DataFrame:
    """Elements that nothing strictly larger contains, one for each class of mutual containment: the first by name.

    names: name. contained: a, b where a lies within b; an element in itself doesn't count. Elements that
    ``contained`` doesn't mention stay.
    """
    reach = closure(contained)
    back = reach.select(F.col("b").alias("a"), F.col("a").alias("b"))
    mutual = reach.intersect(back)
    strict = reach.exceptAll(mutual)
    later = mutual.where("b < a").select("a").distinct()
    dropped = strict.select("a").union(later).distinct()
    return names.join(dropped, names["name"] == dropped["a"], "left_anti")


def containment(paf: DataFrame) -> DataFrame:
    """a, b from alignments: over nine tenths of query a (rounded down) align within target b."""
    return paf.where("q <> t and alen > (qlen * 9) div 10").select(F.col("q").alias("a"), F.col("t").alias("b")).distinct()
