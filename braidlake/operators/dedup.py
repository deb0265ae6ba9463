"""Duplicate reads: before alignment, after it, and how near they lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_of(df: DataFrame, by: Sequence[str | Column], score: Column, tie: Column) -> DataFrame:
    """The row of each group with the highest score; among those the one of the least tie.

    One aggregate with partial results, so a hot group is reduced where its rows are.
    """
    row = F.struct(*df.columns)
    best = df.groupBy(*by).agg(F.max_by(row, F.struct(score, negative(tie))).alias("_best"))
    return best.select("_best.*")


def negative(tie: Column) -> Column:
    return -tie.cast("long")


def predup(pairs: DataFrame, bases: int = 40) -> DataFrame:
    """Of pairs with one barcode and the same first bases of both mates, the one of highest total quality.

    pairs: pair_id, barcode, seq1, seq2, quals1, quals2. Pairs without a barcode (null, 0 or below) all stay. Ties: the smallest
    pair_id.
    """
    total = F.aggregate(F.concat("quals1", "quals2"), F.lit(0).cast("long"), lambda s, q: s + q)
    coded = pairs.where("barcode > 0")
    kept = best_of(coded, ["barcode", F.substring("seq1", 1, bases).alias("_s1"), F.substring("seq2", 1, bases).alias("_s2")], total, F.col("pair_id"))
    return kept.unionByName(pairs.where("barcode is null or barcode <= 0"))


ALIGNMENT_KEY = ("barcode", "is_read1", "is_reverse", "tid", "pos", "mate_tid", "mate_pos")


def mark_duplicates(rows: DataFrame, key: Sequence[str] = ALIGNMENT_KEY, order: Sequence[str] = ("qname",), mapped: Column | None = None, name: str = "is_duplicate", salts: int = 1) -> DataFrame:
    """Flag all but the first row of each key, in the given order. Rows that aren't ``mapped`` are never flagged.

    With ``salts`` above 1 a hot key is ranked in that many tasks: the first row of each salt is found there, and
    only those, at most ``salts`` a key, are compared with each other. That costs a second shuffle.
    """
    mapped = F.lit(True) if mapped is None else mapped
    if salts == 1:
        return rows.withColumn(name, mapped & (F.row_number().over(Window.partitionBy(*key, mapped).orderBy(*order)) > 1))
    named = rows.withColumns({"_mapped": mapped, "_salt": F.pmod(F.xxhash64(*order), F.lit(salts))})
    ranked = named.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_mapped", "_salt").orderBy(*order)))
    later = ranked.where("_r > 1").withColumn(name, F.col("_mapped"))
    place = F.row_number().over(Window.partitionBy(*key, "_mapped").orderBy(*order))
    first = ranked.where("_r = 1").withColumn(name, F.col("_mapped") & (place > 1))
    return later.unionByName(first).drop("_mapped", "_salt", "_r")


def group_sizes(rows: DataFrame, key: Sequence[str] = ALIGNMENT_KEY) -> DataFrame:
    """size and groups: histogram of how many rows share a key."""
    return rows.groupBy(*key).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


def duplicate_rate(sizes: DataFrame) -> DataFrame:
    """Share of rows that are duplicates, from a histogram of group sizes."""
    return sizes.agg(F.try_divide(F.sum((F.col("size") - 1) * F.col("groups")), F.sum(F.col("size") * F.col("groups"))).alias("rate"))


def summary(rows: DataFrame, key: Sequence[str] = ALIGNMENT_KEY, perfect: Column | None = None, rates: Sequence[float] = (1.0,)) -> DataFrame:
    """Duplicate rates for all or perfect rows, with or without the barcode in the key, at several depths.

    Rows: reads, use_barcode, rate_kept, size, groups. Depths above 1 are left out. Rows are dealt to the
    configurations they belong to in one pass.
    """
    perfect = F.lit(True) if perfect is None else perfect
    # pairs stay together: the hash is of the key without the barcode
    draw = F.pmod(F.xxhash64(*[k for k in key if k != "barcode"]), F.lit(1_000_000)) / 1e6
    options = [
        F.when((perfect if which == "perfect" else F.lit(True)) & (draw < rate), F.struct(F.lit(which).alias("reads"), F.lit(use).alias("use_barcode"), F.lit(float(rate)).alias("rate_kept")))
        for which in ("all", "perfect")
        for use in (True, False)
        for rate in rates
        if rate <= 1.0
    ]
    dealt = rows.withColumn("_c", F.explode(F.filter(F.array(*options), lambda c: c.isNotNull())))
    key_of = [F.when(F.col("_c.use_barcode"), F.col(k)).alias(k) if k == "barcode" else F.col(k) for k in key]
    sizes = dealt.groupBy("_c.reads", "_c.use_barcode", "_c.rate_kept", *key_of).agg(F.count("*").alias("size"))
    return sizes.groupBy("reads", "use_barcode", "rate_kept", "size").agg(F.count("*").alias("groups"))


def proximal(rows: DataFrame, key: Sequence[str] = ALIGNMENT_KEY, order: Sequence[str] = ("qname",), first: int = 100, optical: int = 100, diffusion: int = 25_000) -> DataFrame:
    """kind, distance and n over pairs of duplicates in one lane: optical and diffusion duplicates by distance.

    rows also have flowcell, lane, x and y. Of each group the first ``first`` rows, in order, are compared with
    those after them, so a group of n rows makes at most first * n pairs.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    ranked = rows.withColumn("_r", place).select(*key, "flowcell", "lane", "x", "y", "_r")
    a, b = ranked.where(F.col("_r") <= first).alias("a"), ranked.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*key, "flowcell", "lane")]
    on = F.col("a._r") < F.col("b._r")
    for s in same:
        on = on & s
    far = F.sqrt(F.pow(F.col("a.x") - F.col("b.x"), F.lit(2.0)) + F.pow(F.col("a.y") - F.col("b.y"), F.lit(2.0)))
    found = a.join(b, on).select(far.alias("d")).where(F.col("d") < diffusion)
    kind = F.when(F.col("d") < optical, "optical").otherwise("diffusion")
    counted = found.groupBy(kind.alias("kind"), F.floor("d").alias("distance")).agg(F.count("*").alias("n"))
    # without an optical duplicate there is no histogram
    some = F.max((F.col("kind") == "optical").cast("int")).over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("_some", some).where("_some = 1").drop("_some")
