"""Counts, histograms and report figures over reads, barcodes, edges and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.numeric import overlap

from . import nstats


def value_counts(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Distinct rows and their multiplicity."""
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def count_histogram(df: DataFrame, *columns: str) -> DataFrame:
    """size and groups: how many distinct keys occur how often."""
    return value_counts(df, *columns, name="size").groupBy("size").agg(F.count("*").alias("groups"))


def binned(df: DataFrame, value: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """bin (its lower bound, counted from the minimum of all values) and n.

    The width is divided by ten until the range holds a whole bin; constant values make one bin.
    """
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.groupBy(*by, F.lit(0.0).alias("bin")).agg(F.count("*").alias("n")).where("false")
    reach = float(high) - float(low)
    while reach > 0 and int(reach / width) == 0:
        width /= 10
    place = F.lit(float(low)) + (F.floor((F.col(value) - float(low)) / width) * width if reach > 0 else 0.0)
    return df.where(F.col(value).isNotNull()).groupBy(*by, place.cast("double").alias("bin")).agg(F.count("*").alias("n"))


def barcode_counts(reads: DataFrame, whitelist: DataFrame, group: str = "gem_group", barcode: str = "barcode") -> DataFrame:
    """For each group: reads of each whitelisted barcode, with the group's count of others and their share.

    Reads are counted by barcode before they meet the whitelist.
    """
    counted = value_counts(reads, group, barcode)
    named = counted.join(whitelist.select(barcode).distinct().withColumn("known", F.lit(True)), barcode, "left")
    whole = Window.partitionBy(group)
    bad = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).over(whole)
    return named.withColumns({"bad": bad, "error_rate": F.try_divide(bad, F.sum("n").over(whole))}).where("known").drop("known")


def lot(counts: DataFrame, lots: DataFrame, barcode: str = "barcode", prefix: int = 7) -> DataFrame:
    """Which lot the barcodes come from, by their first letters. counts: barcode, n. lots: prefix, lot.

    lot, reads of it, and confidence: 'insufficient data' below 1000 reads, 'confident' from 95 %, else 'ambiguous'.
    """
    per = counts.withColumn("prefix", F.substring(barcode, 1, prefix)).groupBy("prefix").agg(F.sum("n").alias("n")).join(lots, "prefix").groupBy("lot").agg(F.sum("n").alias("n"))
    best = per.agg(F.max_by("lot", F.struct("n", "lot")).alias("lot"), F.max("n").alias("reads"), F.sum("n").alias("total"))
    verdict = F.when(F.coalesce("total", F.lit(0)) < 1000, "insufficient data").when(F.col("reads") >= 0.95 * F.col("total"), "confident").otherwise("ambiguous")
    return best.withColumn("confidence", verdict)


def quality_histogram(reads: DataFrame, quals: str = "quals", mate: str = "mate") -> DataFrame:
    """mate, pos, q, n: how often each quality occurs at each position."""
    return quality_counts(reads.select(F.col(mate).alias("mate"), F.posexplode(quals).alias("pos", "q")))


def quality_counts(cycles: DataFrame) -> DataFrame:
    """The same from rows that are single cycles: mate, pos, q."""
    return cycles.groupBy("mate", "pos", "q").agg(F.count("*").alias("n"))


def bad_cycles(hist: DataFrame, least: int = 1000, low: int = 2, share: float = 0.5) -> DataFrame:
    """Positions with more than ``least`` observations of which over ``share`` have a quality of at most ``low``."""
    per = hist.groupBy("mate", "pos").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("q") <= low, F.col("n")).otherwise(0)).alias("n_low"))
    return per.withColumn("share", F.col("n_low") / F.col("n")).where((F.col("n") > least) & (F.col("share") > share))


def q_share(hist: DataFrame, least: int = 30, mate: int = 1) -> DataFrame:
    """Percentage of a mate's qualities that are at least ``least``."""
    good = F.sum(F.when(F.col("q") >= least, F.col("n")).otherwise(0))
    return hist.where(F.col("mate") == mate).agg(F.try_divide(100 * good, F.sum("n")).alias("percent"))


def valid_barcode_percent(reads: DataFrame, barcode: str = "barcode") -> DataFrame:
    """Percentage of reads that have a barcode."""
    return reads.agg(F.try_divide(100 * F.count_if(F.col(barcode) > 0), F.count("*")).alias("percent"))


def read_totals(reads: DataFrame, length: Column, k: int = 48) -> DataFrame:
    """Shortest, longest and summed length, and the number of k-mers."""
    return reads.agg(
        F.count("*").alias("reads"), F.min(length).alias("shortest"), F.max(length).alias("longest"), F.sum(length).alias("bases"), F.sum(F.when(length >= k, length - k + 1).otherwise(0)).alias("kmers")
    )


def barcode_load(reads: DataFrame, barcode: str = "barcode", big: int = 50_000) -> DataFrame:
    """N50 of reads for each barcode, and the percentage of reads in barcodes of at least ``big`` reads."""
    counted = value_counts(reads.where(F.col(barcode) > 0), barcode)
    share = counted.agg(F.try_divide(100 * F.sum(F.when(F.col("n") >= big, F.col("n")).otherwise(0)), F.sum("n"))).first()[0]
    return nstats.n50(counted, "n", name="reads_n50").withColumn("big_percent", F.lit(share))


def occupancy(counts: DataFrame, diversity: float, n: str = "n", share: float = 0.99, least: int = 4) -> DataFrame:
    """Partitions that were loaded, from barcodes seen: -ln(1 - seen / diversity) * diversity.

    Good barcodes are the largest that hold ``share`` of all reads, with at least ``least`` reads each; 0 if the
    diversity isn't known or is exceeded. counts has a row for each barcode; as counts are taken inclusive of both
    ends of a run, each is one more than its reads.
    """
    hist = counts.groupBy((F.col(n) + 1).alias("v")).agg(F.count("*").alias("c"))
    down = Window.orderBy(F.desc("v"))
    rows = hist.withColumns({"upto": F.sum(F.col("v") * F.col("c")).over(down), "total": F.sum(F.col("v") * F.col("c")).over(Window.partitionBy(F.lit(0)))})
    # of the size at which the share is reached, as many as it takes
    room = F.greatest(F.lit(0), F.ceil((F.col("total") * share - (F.col("upto") - F.col("v") * F.col("c"))) / F.col("v")))
    good = F.coalesce(F.sum(F.when(F.col("v") >= least, F.least(F.col("c"), room)).otherwise(0)), F.lit(0))
    p = F.col("good") / F.lit(float(diversity)) if diversity > 0 else F.lit(2.0)
    return rows.agg(good.cast("long").alias("good")).withColumn("partitions", F.when((p < 1) & (p >= 0), -F.log(1 - p) * diversity).otherwise(0.0))


def insert_sizes(placements: DataFrame, room: int = 1000, most: int = 1000) -> DataFrame:
    """len and n over pairs whose mates lie on one edge. placements: pair_id, mate, edge, start, stop, edge_length."""
    a, b = placements.where("mate = 0").alias("a"), placements.where("mate = 1").alias("b")
    pairs = a.join(b, (F.col("a.pair_id") == F.col("b.pair_id")) & (F.col("a.edge") == F.col("b.edge")))
    size = F.col("b.stop") - F.col("a.start")
    fits = (F.col("a.start") + room <= F.col("a.edge_length")) & size.between(0, most)
    return pairs.where(fits).groupBy(size.alias("len")).agg(F.count("*").alias("n"))


def proper_pair_percent(placements: DataFrame, most: int = 1000) -> DataFrame:
    """Percentage of placed second mates whose first mate lies before them on the same edge, not too far."""
    a, b = placements.where("mate = 0").alias("a"), placements.where("mate = 1").alias("b")
    rows = b.join(a, (F.col("a.pair_id") == F.col("b.pair_id")) & (F.col("a.edge") == F.col("b.edge")), "left")
    proper = (F.col("b.stop") - F.col("a.start")).between(0, most)
    return rows.agg(F.try_divide(100 * F.count_if(proper), F.count("*")).alias("percent"))


def edge_barcodes(placements: DataFrame, edge: str = "edge", reverse_edge: str = "rc_edge", barcode: str = "barcode") -> DataFrame:
    """edge, barcode: the distinct barcodes of each edge and of its reverse complement."""
    some = placements.where(F.col(barcode) > 0)
    both = some.select(F.col(edge).alias("edge"), F.col(barcode).alias("barcode")).unionByName(some.select(F.col(reverse_edge).alias("edge"), F.col(barcode).alias("barcode")))
    return both.distinct()


def inverted_index(paths: DataFrame, item: str = "edges", owner: str = "read_id") -> DataFrame:
    """A row for each edge of each path: edge, owner, its place in the path. Grouping is left to who needs it."""
    return paths.select(F.posexplode(item).alias("place", "edge"), F.col(owner).alias("owner")).select("edge", "owner", "place")


def support(paths: DataFrame, item: str = "edges", most: int = 65_535) -> DataFrame:
    """Paths through each edge; the count stays at the largest number of 16 bits."""
    return paths.select(F.explode(item).alias("edge")).groupBy("edge").agg(F.least(F.count("*"), F.lit(most)).alias("n"))


def bigrams(paths: DataFrame, item: str = "edges") -> DataFrame:
    """a, b, n: how often edge b follows edge a."""
    e = F.col(item)
    steps = F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda i: F.struct(F.element_at(e, i).alias("a"), F.element_at(e, i + 1).alias("b")))
    return paths.where(F.size(e) > 1).select(F.explode(steps).alias("s")).groupBy("s.a", "s.b").agg(F.count("*").alias("n"))


def line_lengths(branches: DataFrame) -> DataFrame:
    """Length of each line: over its cells, the sum of the median branch. branches: line, cell, length.

    Of an even number of branches the median is the longer of the middle two.
    """
    ranked = branches.withColumns(
        {"r": F.row_number().over(Window.partitionBy("line", "cell").orderBy("length")), "n": F.count("*").over(Window.partitionBy("line", "cell"))}
    )
    return ranked.where("r = n div 2 + 1").groupBy("line").agg(F.sum("length").alias("length"))


def copy_numbers(spans: DataFrame, lines: DataFrame, least: int = 1000, most: int = 100_000, factor: float = 1.1) -> DataFrame:
    """Copies of each line: coverage by molecules that bridge flanks of growing size, over the mean, times two.

    spans: line, start, stop of molecules. lines: line, length. A flank counts on lines of at least twice its size.
    """
    sizes, at = [], float(least)
    while at <= most:
        sizes.append(int(at))
        at *= factor
    flank = lines.withColumn("flank", F.explode(F.array(*[F.lit(s) for s in sizes]))).where("length >= 2 * flank")
    covered = overlap(F.col("start"), F.col("stop"), F.lit(0), F.col("flank")) + overlap(F.col("start"), F.col("stop"), F.col("length") - F.col("flank"), F.col("length"))
    # a line's flanks are a bounded number, so the join makes that many rows a span
    per = flank.join(spans, "line", "left").groupBy("line", "flank").agg((F.sum(F.coalesce(covered, F.lit(0))) / (2.0 * F.col("flank"))).alias("coverage"))
    means = per.groupBy("flank").agg(F.avg("coverage").alias("mean"))
    return per.join(F.broadcast(means), "flank").where("mean > 0").groupBy("line").agg((2 * F.avg(F.col("coverage") / F.col("mean"))).alias("copies"))


def coverage(spans: DataFrame, lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw coverage of each line (bases of spans over length) and coverage over the mean of all lines."""
    sums = spans.groupBy(*by, "line").agg(F.sum(F.col("stop") - F.col("start")).alias("bases"))
    raw = lines.join(sums, "line", "left").withColumn("raw", F.try_divide(F.coalesce("bases", F.lit(0)), F.col("length")))
    mean = raw.groupBy(*by).agg(F.try_divide(F.sum(F.coalesce("bases", F.lit(0))), F.sum("length")).alias("mean"))
    joined = raw.join(mean, list(by)) if by else raw.withColumn("mean", F.lit(mean.first()[0]))
    return joined.withColumn("normalised", F.try_divide("raw", "mean")).select(*by, "line", "raw", "normalised")


def assembly_report(lengths: DataFrame, least: int = 0) -> DataFrame:
    """A row for each kind of length: count, sum, longest, N50, N60. lengths: kind, length."""
    some = lengths.where(F.col("length") >= max(1, least))
    basic = some.groupBy("kind").agg(F.count("*").alias("n"), F.sum("length").alias("total"), F.max("length").alias("longest"))
    n60 = nstats.n_levels(some, "length", ["kind"], [60]).select("kind", F.col("n").alias("n60"))
    return basic.join(nstats.n50(some, "length", ["kind"]), "kind").join(n60, "kind")


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that fire. metrics: name, value. rules: metric, threshold, compare, action, text.

    '<' fires below the threshold and '>' at it or above. ``{}`` in a text is the value. If a rule of action
    'exit' fires, only those are returned.
    """
    both = metrics.join(rules, metrics["name"] == rules["metric"]).where((F.col("compare") == ">") != (F.col("value") < F.col("threshold")))
    fatal = F.max((F.col("action") == "exit").cast("int")).over(Window.partitionBy(F.lit(0)))
    shown = F.replace(F.col("text"), F.lit("{}"), F.col("value").cast("string"))
    return both.withColumn("_fatal", fatal).where("_fatal = 0 or action = 'exit'").select("metric", "value", "action", shown.alias("text"))


def duplicate_rules(rules: DataFrame) -> DataFrame:
    """Rules of one metric with the same level, which mustn't be: metric, threshold, n."""
    return rules.groupBy("metric", "threshold", "compare").agg(F.count("*").alias("n")).where("n > 1")


def split_statistics(reads: DataFrame, barcode: str = "barcode", possible: int = 1536**3) -> DataFrame:
    """Barcode types seen, their share of those possible, pairs, and the percentage of pairs with a barcode."""
    counted = value_counts(reads, barcode)
    return counted.agg(
        F.count_if(F.col(barcode) != "0_0_0").alias("types"),
        (100.0 * F.count_if(F.col(barcode) != "0_0_0") / possible).alias("types_percent"),
        F.sum("n").alias("pairs"),
        F.try_divide(100.0 * F.sum(F.when(F.col(barcode) != "0_0_0", F.col("n")).otherwise(0)), F.sum("n")).alias("split_percent"),
    )


def merged_histograms(parts: DataFrame, *keys: str, n: str = "n") -> DataFrame:
    """Histograms of several chunks as one."""
    return parts.groupBy(*keys).agg(F.sum(n).alias(n))
