"""Order-dependent operators: sessions, runs, flanks, peaks and gap sizes."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.runtime import map_arrow


def sessions(rows: DataFrame, by: Sequence[str], at: Column, most: int | float, tie: str | None = None, name: str = "session") -> DataFrame:
    """Number the runs of each group: a new one begins where the step from the row before exceeds ``most``."""
    order = Window.partitionBy(*by).orderBy(at, *([tie] if tie else []))
    step = at - F.lag(at).over(order)
    return rows.withColumn("_new", F.coalesce((step > most).cast("int"), F.lit(0))).withColumn(name, F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def molecules(reads: DataFrame, lines: DataFrame, gap: int = 60_000, least: int = 4, shortest: int = 1000) -> DataFrame:
    """Molecules inferred from reads of one barcode near each other on a line.

    reads: line, barcode, pos, pair_id. lines: line, length. A step above ``gap`` starts a new molecule. With n
    distinct pairs besides the first read's own, and n at least ``least``, its length is (n + 1) / (n - 1) times
    its span, cut to an integer; kept if that and the line exceed ``shortest`` and it lies farther than ``gap`` from
    both ends of the line.
    """
    numbered = sessions(reads, ["line", "barcode"], F.col("pos"), gap, "pair_id")
    per = numbered.groupBy("line", "barcode", "session").agg((F.count_distinct("pair_id") - 1).alias("pairs"), F.min("pos").alias("start"), F.max("pos").alias("stop"))
    sized = per.where(F.col("pairs") >= least).withColumn("length", F.floor((F.col("pairs") + 1) / (F.col("pairs") - 1) * (F.col("stop") - F.col("start"))))
    named = lines.select("line", F.col("length").alias("_line"))
    return sized.join(named, "line").where((F.col("length") > shortest) & (F.col("_line") > shortest) & (F.col("start") > gap) & (F.col("_line") - F.col("stop") > gap)).drop("_line")


def territories(reads: DataFrame, gap: int = 100_000, least: int = 3, reach: int = 25_000) -> DataFrame:
    """Where each barcode is at home: runs of at least ``least`` reads on a line, extended on both sides."""
    numbered = sessions(reads, ["barcode", "line"], F.col("pos"), gap)
    per = numbered.groupBy("barcode", "line", "session").agg(F.count("*").alias("reads"), (F.min("pos") - reach).alias("start"), (F.max("pos") + reach).alias("stop"))
    return per.where(F.col("reads") >= least).drop("session")


def order_score(reads: DataFrame, ratio: float = 2.0) -> DataFrame:
    """How badly an order of lines suits the barcodes: rows ordering, score.

    reads: ordering, barcode, pos (along the ordering), line_index. Within a barcode each step onto a later line
    that is at least ``ratio`` times the mean step adds that ratio.
    """
    order = Window.partitionBy("ordering", "barcode").orderBy("pos")
    rows = reads.withColumns({"step": F.col("pos") - F.lag("pos").over(order), "rises": F.col("line_index") > F.lag("line_index").over(order)})
    mean = F.avg("step").over(Window.partitionBy("ordering", "barcode"))
    rows = rows.withColumn("r", F.when(mean > 0, F.col("step") / mean))
    return rows.groupBy("ordering").agg(F.sum(F.when(F.col("rises") & (F.col("r") >= ratio), F.col("r")).otherwise(0.0)).alias("score"))


def bridging(points: DataFrame, middles: DataFrame, flank: int, ignore: int = 0) -> DataFrame:
    """middle, left, right, bridges: barcodes on either side of a place and on both.

    points: line, pos, barcode. middles: line, middle. Both flanks reach from ``ignore`` to ``flank`` off the place.
    Points are found by bins of the flank's width.
    """
    bins = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.floor(F.col("middle") / flank) + d)
    near = points.withColumn("_bin", F.floor(F.col("pos") / flank)).join(middles.withColumn("_bin", F.explode(bins)), ["line", "_bin"])
    off = F.col("pos") - F.col("middle")
    side = F.when(off.between(-flank, -ignore), "l").when(off.between(ignore, flank), "r")
    per = near.withColumn("side", side).where("side is not null").groupBy("line", "middle", "barcode").agg(F.max((F.col("side") == "l").cast("int")).alias("l"), F.max((F.col("side") == "r").cast("int")).alias("r"))
    return per.groupBy("line", "middle").agg(F.sum("l").alias("left"), F.sum("r").alias("right"), F.sum(F.col("l") * F.col("r")).alias("bridges"))


def runs(flags: DataFrame, by: Sequence[str], at: str, flag: Column) -> DataFrame:
    """start and stop (half open) of the maximal runs of consecutive positions with the flag, for each group."""
    on = flags.where(flag)
    island = F.col(at) - F.row_number().over(Window.partitionBy(*by).orderBy(at))
    return on.withColumn("_i", island).groupBy(*by, "_i").agg(F.min(at).alias("start"), (F.max(at) + 1).alias("stop")).drop("_i")


def character_runs(rows: DataFrame, by: Sequence[str], seq: str, chars: str = "Nn", least: int = 1) -> DataFrame:
    """start and stop (half open) of the maximal runs of these characters that are at least so long.

    Sequences are scanned in Arrow batches, in one pass each: a fold that collects runs would copy them again for
    every run.
    """
    pattern = re.compile(f"[{re.escape(chars)}]{{{least},}}")
    kept = rows.where(F.col(seq).isNotNull()).select(*by, seq)
    schema = T.StructType([*(f for f in kept.schema if f.name in by), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[m.span() for m in pattern.finditer(text)] for text in batch.column(len(by)).to_pylist()]
            owner = pa.array([i for i, spans in enumerate(found) for _ in spans], pa.int64())
            bounds = [pa.array([s[k] for spans in found for s in spans], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(owner) for i in range(len(by))), *bounds], names=schema.names)

    return map_arrow(kept, run, schema)


def called_coordinate(gaps: DataFrame, points: DataFrame, pos: str = "pos", by: Sequence[str] = ("scaffold_id",)) -> DataFrame:
    """Coordinates that leave gaps out, translated to those that count them.

    gaps: start, stop. A point goes behind every gap that begins at or before it in coordinates without gaps.
    """
    order = Window.partitionBy(*by).orderBy("start")
    before = F.coalesce(F.sum(F.col("stop") - F.col("start")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marks = gaps.select(*by, (F.col("start") - before).alias("_at"), (F.col("stop") - F.col("start")).alias("_size"), F.lit(0).alias("_kind"), F.lit(None).cast("struct<x:int>").alias("_row"))
    named = points.select(*by, F.col(pos).alias("_at"), F.lit(0).alias("_size"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_row"))
    both = marks.drop("_row").withColumn("_row", F.lit(None).cast(named.schema["_row"].dataType)).unionByName(named)
    shift = F.sum("_size").over(Window.partitionBy(*by).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_shift", shift).where("_kind = 1").select("_row.*", (F.col("_at") + F.col("_shift")).alias("scaffold_pos"))


def rolling(rows: DataFrame, value: str, order: Sequence[str], around: int, by: Sequence[str] = ()) -> DataFrame:
    """Least, largest, sum and mean over the rows within ``around`` places."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-around, around)
    return rows.withColumns({f"{value}_min": F.min(value).over(w), f"{value}_max": F.max(value).over(w), f"{value}_sum": F.sum(value).over(w), f"{value}_mean": F.avg(value).over(w)})


def cumulative_sum(rows: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(f"{value}_upto", F.sum(value).over(w))


def peaks(rows: DataFrame, by: Sequence[str] = (), around: int = 10, share: float = 1e-4, spread: float = 0.05, drop: float = 1.2) -> DataFrame:
    """x, y of the peaks of a curve: the largest within ``around`` points and within ``spread`` of x, at least ``share``
    of the largest of all, with a point of at most y / ``drop`` on both sides before any higher one.

    A curve, such as a spectrum, has few points; each is handled as a whole.
    """
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in by), "x double, y double"])

    def of(curve: pd.DataFrame) -> pd.DataFrame:
        curve = curve.sort_values("x")
        x, y = curve["x"].to_numpy(float), curve["y"].to_numpy(float)
        found = []
        for i in range(len(x)):
            near = (np.abs(x - x[i]) <= spread * abs(x[i])) | (np.abs(np.arange(len(x)) - i) <= around)
            if y[i] < y[near].max() or y[i] < share * y.max():
                continue
            sides = []
            for side in (y[:i][::-1], y[i + 1 :]):
                higher = np.flatnonzero(side > y[i])
                sides.append((side[: higher[0] if len(higher) else None] * drop <= y[i]).any())
            if all(sides):
                found.append(i)
        out = curve.iloc[found]
        return pd.DataFrame({**{c: out[c] for c in by}, "x": x[found], "y": y[found]})

    return rows.groupBy(*by).applyInPandas(of, schema)


def flank_barcodes(points: DataFrame, shells: DataFrame, least: int = 1) -> DataFrame:
    """Barcodes of half-open flanks: shell columns and barcode, reads. shells: id, scaffold_id, start, stop."""
    from .joins import point_join

    found = point_join(points, shells, 20_000, "pos", ["scaffold_id"])
    return found.groupBy("id", "barcode").agg(F.count("*").alias("reads")).where(F.col("reads") >= least)


def calibrate_gaps(points: DataFrame, scaffolds: DataFrame, gaps: DataFrame, window: int, most: int, step: int = 5000, stride: int = 50) -> DataFrame:
    """gap and fraction: of two windows that far apart, the mean share of their barcodes that both have.

    points: scaffold_id, pos, barcode. scaffolds: scaffold_id, length. gaps: scaffold_id, start, stop. A pair of
    windows is laid every ``stride`` windows on each scaffold; those that touch a gap are left out. A barcode
    counts if seen twice in a window.
    """
    from .joins import interval_join

    sizes = F.sequence(F.lit(0), F.lit(most), F.lit(step))
    laid = scaffolds.withColumn("gap", F.explode(sizes)).withColumn("_last", F.col("length") - 2 * window - F.col("gap")).where("_last >= 0")
    laid = laid.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last").cast("long"), F.lit(window * stride).cast("long"))))
    laid = laid.select("scaffold_id", "gap", "at", F.col("at").alias("start"), (F.col("at") + 2 * window + F.col("gap")).alias("stop"))
    touched = interval_join(laid, gaps, 100_000, ["scaffold_id"]).select("scaffold_id", F.col("l_gap").alias("gap"), F.col("l_at").alias("at")).distinct()
    free = laid.join(touched, ["scaffold_id", "gap", "at"], "left_anti")
    sides = F.array(F.struct(F.lit("l").alias("side"), F.col("at").alias("start")), F.struct(F.lit("r").alias("side"), (F.col("at") + window + F.col("gap")).alias("start")))
    shells = free.withColumn("s", F.explode(sides)).select(F.struct("scaffold_id", "gap", "at", "s.side").alias("id"), "scaffold_id", F.col("s.start").alias("start"), (F.col("s.start") + window).alias("stop"))
    seen = flank_barcodes(points, shells, 2).select(F.col("id.scaffold_id").alias("scaffold_id"), F.col("id.gap").alias("gap"), F.col("id.at").alias("at"), F.col("id.side").alias("side"), "barcode")
    per = seen.groupBy("scaffold_id", "gap", "at", "barcode").agg(F.count("*").alias("sides")).groupBy("scaffold_id", "gap", "at").agg((F.count_if(F.col("sides") == 2) / F.count("*")).alias("f"))
    return per.groupBy("gap").agg(F.avg("f").alias("fraction"))


#: What a gap is taken to be if nothing tells its size.
DEFAULT_GAP = 30_000
LEAST_GAP = 400


def estimate_gaps(joins: DataFrame, points: DataFrame, scaffolds: DataFrame, gaps: DataFrame, calibration: DataFrame, window: int, shells: int = 3) -> DataFrame:
    """join_id and gap between the ends of two scaffolds.

    joins: join_id, a, a_tail, b, b_tail: the scaffolds and whether their far end (tail) is joined. Shell p looks at
    the windows from (p - 1) to p windows off both ends. A shell outside a scaffold is skipped; from the first that
    touches a gap on, the rest is unused. A shell's bridge fraction below half of the last calibration's is
    skipped; otherwise the closest calibrated gap, at least 400, less 2 (p - 1) windows. The gap is the integer
    mean of the values that aren't negative, or 30 000 without one.
    """
    from .joins import interval_join, nearest

    shell = joins.withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(shells))))
    ends = F.array(F.struct(F.lit("a").alias("side"), F.col("a").alias("scaffold_id"), F.col("a_tail").alias("tail")), F.struct(F.lit("b").alias("side"), F.col("b").alias("scaffold_id"), F.col("b_tail").alias("tail")))
    placed = shell.withColumn("e", F.explode(ends)).select("join_id", "p", "e.*").join(scaffolds, "scaffold_id")
    start = F.when(F.col("tail"), F.col("length") - F.col("p") * window).otherwise((F.col("p") - 1) * window)
    placed = placed.withColumns({"start": start, "stop": start + window})
    inside = F.min((F.col("start") >= 0) & (F.col("stop") <= F.col("length"))).over(Window.partitionBy("join_id", "p"))
    placed = placed.withColumn("inside", inside).where("inside")
    touched = interval_join(placed, gaps, 100_000, ["scaffold_id"]).groupBy(F.col("l_join_id").alias("join_id")).agg(F.min("l_p").alias("blocked"))
    usable = placed.join(touched, "join_id", "left").where("blocked is null or p < blocked")
    seen = flank_barcodes(points, usable.select(F.struct("join_id", "p", "side").alias("id"), "scaffold_id", "start", "stop"), 2)
    per = seen.groupBy(F.col("id.join_id").alias("join_id"), F.col("id.p").alias("p"), "barcode").agg(F.count("*").alias("sides"))
    fractions = per.groupBy("join_id", "p").agg((F.count_if(F.col("sides") == 2) / F.count("*")).alias("f"))
    last = calibration.agg(F.max_by("fraction", "gap")).first()[0]
    if last is None:
        return joins.select("join_id", F.lit(DEFAULT_GAP).cast("long").alias("gap"))
    best = nearest(fractions.where(F.col("f") >= last / 2), calibration.select("fraction", "gap"), "f", "fraction", "gap")
    value = F.greatest(F.col("gap"), F.lit(LEAST_GAP)) - 2 * (F.col("p") - 1) * window
    means = best.withColumn("v", value).where("v >= 0").groupBy("join_id").agg(F.expr("cast(sum(v) div count(v) as bigint)").alias("gap"))
    return joins.select("join_id").join(means, "join_id", "left").select("join_id", F.coalesce("gap", F.lit(DEFAULT_GAP)).cast("long").alias("gap"))
