"""Joins that Spark has no single operator for: mismatch-tolerant, interval, nearest, set overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.numeric import error_probability
from braidlake.functions.sequence import neighbours, second_neighbours
from braidlake.runtime import materialize

#: Below this many rows a side is broadcast; it is counted first.
SMALL_SIDE = 200_000
#: A calibration table of so many entries becomes part of the plan; a larger one is met in ranges.
PLAN_ENTRIES = 20_000


def small(df: DataFrame) -> DataFrame:
    """The same, marked for broadcast if a bounded count shows that it is small."""
    return F.broadcast(df) if df.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else df


def zip_streams(left: DataFrame, right: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Rows of parallel streams that carry the same name; a name with fewer than ``least`` rows on the left is an error."""
    counted = left.withColumn("_n", F.count("*").over(Window.partitionBy(key)))
    checked = counted.withColumn("_ok", F.assert_true(F.col("_n") >= least, F.concat(F.lit("too few rows of "), F.col(key).cast("string"))))
    return checked.where(F.col("_ok").isNull()).drop("_ok", "_n").join(right, key)


def whitelist_lookup(reads: DataFrame, whitelist: DataFrame, key: str = "barcode") -> DataFrame:
    """Reads with the place of their barcode in the whitelist; null if it isn't there."""
    return reads.join(small(whitelist), key, "left")


def expanded(whitelist: DataFrame, segment: str = "segment", number: str = "barcode_id", order: str | None = None) -> DataFrame:
    """Every string within one mismatch of a segment, and the segment's number. Where several claim it, the last does."""
    order = order or number
    words = F.concat(F.array(F.col(segment)), neighbours(F.col(segment)))
    return whitelist.select(F.explode(words).alias("word"), F.col(number).alias("number"), F.col(order).alias("at")).groupBy("word").agg(F.max_by("number", "at").alias("number"))


def demultiplex(reads: DataFrame, whitelist: DataFrame, seq: str = "seq", start: int = 0, offsets: Sequence[int] = (0, 16, 32), width: int = 10) -> DataFrame:
    """Reads with ``barcode``: the numbers of their three segments as ``a_b_c``, or 0_0_0 if one isn't recognised.

    The table of strings is of the whitelist's size, not the reads'; reads with an N are never recognised there.
    """
    table = small(expanded(whitelist))
    out = reads
    for i, offset in enumerate(offsets):
        out = out.withColumn(f"_w{i}", F.substring(seq, start + offset + 1, width)).join(
            table.select(F.col("word").alias(f"_w{i}"), F.col("number").alias(f"_n{i}")), f"_w{i}", "left"
        )
    found = [F.col(f"_n{i}") for i in range(len(offsets))]
    known = F.lit(True)
    for f in found:
        known = known & f.isNotNull()
    barcode = F.when(known, F.concat_ws("_", *[f.cast("string") for f in found])).otherwise("_".join("0" * len(offsets)))
    return out.withColumn("barcode", barcode).drop(*[f"_w{i}" for i in range(len(offsets))], *[f"_n{i}" for i in range(len(offsets))])


def correct_barcodes(reads: DataFrame, counts: DataFrame, confidence: float = 0.975, trusted: int = 24) -> DataFrame:
    """Barcodes corrected to the likeliest whitelisted one.

    reads: read_id, raw (barcode), quals (array). counts: barcode, n for every whitelisted barcode. The prior is
    (n + 1) over its sum. A whitelisted barcode whose qualities all exceed ``trusted`` passes. Another whitelisted
    one competes, with its prior, against those two mismatches away; one off the list is matched to those one
    mismatch away. A mismatch weighs its error probability. The best wins if its share exceeds ``confidence`` and
    it has a rival; otherwise the result is null.

    Candidates are made only for barcodes that are short of trust, and looked up in the whitelist by equality.
    """
    total = F.sum(F.col("n") + 1).over(Window.partitionBy(F.lit(0)))
    prior = small(counts.select(F.col("barcode").alias("candidate"), ((F.col("n") + 1) / total).alias("prior")))
    # five branches read this, of which most rows take the first
    known = materialize(reads.join(prior.withColumnRenamed("candidate", "raw"), "raw", "left").select("read_id", "raw", "quals", "prior"), "known")
    passed = F.col("prior").isNotNull() & F.forall("quals", lambda q: q > trusted)
    easy = known.where(passed).select("read_id", F.col("raw").alias("barcode"))
    hard = known.where(~F.coalesce(passed, F.lit(False)))
    # one mismatch for those off the list
    off = hard.where("prior is null").select("read_id", "raw", "quals", F.explode(neighbours("raw")).alias("candidate"), F.lit(33).alias("most"), F.lit(0).alias("less"))
    # two mismatches for those on it
    twice = second_neighbours("raw")
    on = hard.where("prior is not null").select("read_id", "raw", "quals", F.explode(twice).alias("candidate"), F.lit(33).alias("most"), F.lit(1).alias("less"))
    rated = off.unionByName(on).join(prior, "candidate")
    at = F.sequence(F.lit(1), F.length("raw"))
    wrong = F.filter(at, lambda i: F.substring("raw", i, F.lit(1)) != F.substring("candidate", i, F.lit(1)))
    quality = lambda i: F.greatest(F.element_at("quals", i) - F.col("less"), F.when(F.col("less") == 1, 3).otherwise(F.element_at("quals", i)))
    likelihood = F.aggregate(wrong, F.lit(1.0), lambda s, i: s * error_probability(quality(i), 33))
    choices = rated.select("read_id", "candidate", (F.col("prior") * likelihood).alias("weight")).unionByName(
        hard.where("prior is not null").select("read_id", F.col("raw").alias("candidate"), F.col("prior").alias("weight"))
    )
    best = choices.groupBy("read_id").agg(F.max_by("candidate", F.struct("weight", "candidate")).alias("best"), F.max("weight").alias("top"), F.sum("weight").alias("all"), F.count("*").alias("n"))
    sure = best.select("read_id", F.when((F.col("top") / F.col("all") > confidence) & (F.col("n") > 1), F.col("best")).alias("barcode"))
    return easy.unionByName(hard.select("read_id").join(sure, "read_id", "left"))


def interval_join(left: DataFrame, right: DataFrame, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of overlapping half-open intervals; both sides have start and stop, which become l_* and r_*.

    Intervals are dealt to bins of ``width``; a pair meets in the bin where its later start lies, so it is found
    once. An interval makes one row for each bin that it covers: choose a width near the typical length.
    """

    def dealt(df: DataFrame, tag: str) -> DataFrame:
        named = df.select(*[F.col(c) if c in by else F.col(c).alias(f"{tag}_{c}") for c in df.columns]).where(F.col(f"{tag}_start") < F.col(f"{tag}_stop"))
        first, last = F.floor(F.col(f"{tag}_start") / width), F.floor((F.col(f"{tag}_stop") - 1) / width)
        return named.withColumn("_bin", F.explode(F.sequence(first, last)))

    pairs = dealt(left, "l").join(dealt(right, "r"), [*by, "_bin"])
    meets = (F.col("l_start") < F.col("r_stop")) & (F.col("r_start") < F.col("l_stop"))
    return pairs.where(meets & (F.floor(F.greatest("l_start", "r_start") / width) == F.col("_bin"))).drop("_bin")


def point_join(points: DataFrame, intervals: DataFrame, width: int, at: str = "pos", by: Sequence[str] = ()) -> DataFrame:
    """Points with the half-open intervals that hold them."""
    bins = F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))
    dealt = intervals.where("start < stop").withColumn("_bin", F.explode(bins))
    return points.withColumn("_bin", F.floor(F.col(at) / width)).join(dealt, [*by, "_bin"]).where((F.col(at) >= F.col("start")) & (F.col(at) < F.col("stop"))).drop("_bin")


def nearest(rows: DataFrame, table: DataFrame, value: str, key: str, result: str) -> DataFrame:
    """rows and, of the entry whose key is closest to their value, the result; of equally close ones the first key.

    A table of at most ``PLAN_ENTRIES`` keys becomes a sorted array in the plan, searched by halves for each row: no
    pairs are made and nothing is shuffled. A larger one is met in ranges (``nearest_in_ranges``). Rows without a
    value take the first key.
    """
    entries = materialize(table.groupBy(F.col(key).cast("double").alias("key")).agg(F.min(result).alias("result")), "entries")
    held = [(r[0], r[1]) for r in entries.orderBy("key").limit(PLAN_ENTRIES + 1).collect()]
    if len(held) > PLAN_ENTRIES:
        return nearest_in_ranges(rows, entries, value, result)
    keys, results = F.lit([k for k, _ in held]), F.lit([r for _, r in held])
    # binary search over the sorted keys, folded over as many halvings as they need
    steps = F.sequence(F.lit(1), F.lit(max(1, len(held).bit_length())))
    state = F.struct(F.lit(0).alias("low"), F.lit(len(held)).alias("high"))
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("int")
    halved = lambda s, _: F.when(s["low"] >= s["high"], s).otherwise(
        F.when(F.get(keys, middle(s)) < F.col(value), F.struct((middle(s) + 1).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), middle(s).alias("high")))
    )
    above = F.aggregate(steps, state, halved)["low"]
    below = above - 1
    take_below = (below >= 0) & ((above >= len(held)) | (F.col(value) - F.get(keys, below) <= F.get(keys, above) - F.col(value)))
    return rows.withColumn(result, F.get(results, F.when(take_below, below).otherwise(above)))


def nearest_in_ranges(rows: DataFrame, entries: DataFrame, value: str, result: str) -> DataFrame:
    """``nearest`` for a table of any size; entries: key (distinct) and result.

    The distinct values and the keys are dealt to ranges and sorted there, so that each value sees the last key up to
    it and the first from it on; where its range has none, the nearest range with a key gives its last or first one.
    A value shared by many rows is looked up once.
    """
    seen = rows.select(F.col(value).cast("double").alias("v")).where("v is not null").distinct().select("v", F.lit(None).cast(entries.schema["result"].dataType).alias("result"), F.lit(False).alias("entry"))
    both = entries.where("key is not null").select(F.col("key").alias("v"), "result", F.lit(True).alias("entry")).unionByName(seen)
    dealt = materialize(both.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ranges")
    at = F.when(F.col("entry"), F.struct(F.col("v").alias("key"), "result"))
    # of a range's keys the ends only: as many rows as there are ranges
    ends = dealt.groupBy("part").agg(F.max(at).alias("highest"), F.min(at).alias("lowest"))
    lower = F.last("highest", True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    upper = F.last("lowest", True).over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select("part", lower.alias("lower"), upper.alias("upper"))
    up = Window.partitionBy("part").orderBy("v", F.desc("entry")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("part").orderBy(F.desc("v"), F.desc("entry")).rowsBetween(Window.unboundedPreceding, 0)
    met = dealt.select("part", "v", "entry", F.last(at, True).over(up).alias("below"), F.last(at, True).over(down).alias("above")).where("not entry")
    met = met.join(F.broadcast(ends), "part").select("v", F.coalesce("below", "lower").alias("below"), F.coalesce("above", "upper").alias("above"))
    closer = F.col("above").isNull() | (F.col("v") - F.col("below.key") <= F.col("above.key") - F.col("v"))
    found = met.select("v", F.when(F.col("below").isNotNull() & closer, F.col("below.result")).otherwise(F.col("above.result")).alias(result))
    first = entries.where("key is not null").agg(F.min(F.struct("key", "result"))["result"].alias("_first"))
    joined = rows.withColumn("_v", F.col(value).cast("double")).join(found.withColumnRenamed("v", "_v"), "_v", "left").crossJoin(F.broadcast(first))
    return joined.withColumn(result, F.when(F.col("_v").isNull(), F.col("_first")).otherwise(F.col(result))).drop("_v", "_first")


def overlap_pairs(items: DataFrame, owner: str = "owner", item: str = "item", most: int | None = None) -> DataFrame:
    """a < b with the number of items they share, both sizes and the Jaccard index.

    items has distinct (owner, item) rows. Pairs are made within an item only; ``most`` leaves out items that more
    owners share, as repeats say little about neighbourhood.
    """
    sizes = items.groupBy(owner).agg(F.count("*").alias("size"))
    used = items
    if most is not None:
        used = items.withColumn("_n", F.count("*").over(Window.partitionBy(item))).where(F.col("_n") <= most).drop("_n")
    a = used.select(F.col(owner).alias("a"), F.col(item).alias("_item"))
    b = used.select(F.col(owner).alias("b"), F.col(item).alias("_item"))
    common = a.join(b, "_item").where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    named = lambda side: sizes.select(F.col(owner).alias(side), F.col("size").alias(f"size_{side}"))
    joined = common.join(named("a"), "a").join(named("b"), "b")
    return joined.withColumn("jaccard", F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))).select("a", "b", "common", "size_a", "size_b", "jaccard")


def neighbour_cut(pairs: DataFrame, least: int = 6, share: float = 0.1) -> DataFrame:
    """For each owner the neighbours that share at least ``least`` items and ``share`` of what the best one does.

    pairs: a, b, common with a < b. Result: owner, neighbour, common.
    """
    both = pairs.select(F.col("a").alias("owner"), F.col("b").alias("neighbour"), "common").unionByName(pairs.select(F.col("b").alias("owner"), F.col("a").alias("neighbour"), "common"))
    best = F.max("common").over(Window.partitionBy("owner"))
    return both.where(F.col("common") >= least).withColumn("_best", best).where(F.col("common") / F.col("_best") >= share).drop("_best")


def end_overlaps(near: DataFrame, far: DataFrame, least: int = 20, jaccard: float = 0.01, long_least: int = 10) -> DataFrame:
    """Pairs of scaffold ends that share barcodes: end = 2 * scaffold or that and 1.

    near and far: end, barcode, reads in the first and second window of an end. A barcode counts with more than 5
    reads. Pairs of one scaffold don't count. Kept: at least ``least`` shared near barcodes and ``jaccard``, and
    either ``long_least`` shared far barcodes or ten times as many of them as near ones.
    """
    some = lambda df: df.where("reads > 5").select(F.col("end").alias("owner"), F.col("barcode").alias("item"))
    close = overlap_pairs(some(near)).where("a div 2 <> b div 2")
    distant = overlap_pairs(some(far)).select("a", "b", F.col("common").alias("far_common"))
    both = close.join(distant, ["a", "b"], "left").withColumn("far_common", F.coalesce("far_common", F.lit(0)))
    return both.where((F.col("common") >= least) & (F.col("jaccard") >= jaccard) & ((F.col("far_common") >= long_least) | (10 * F.col("far_common") >= F.col("common"))))
