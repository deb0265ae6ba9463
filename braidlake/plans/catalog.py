"""Registered queries of the operators, and the SQL that gives the same rows.

Every query runs over its whole tables. Entries without SQL are tested on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.functions import ambiguous
from braidlake.functions import numeric as N
from braidlake.functions import sequence as S
from braidlake.operators import aggregates, alignment, dedup, graph, intervals, joins, kmers, nstats, sets, sorting, windows
from braidlake.operators import lines as lines_
from braidlake.runtime import spread, table
from braidlake.streaming import events as streams

from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


# N-statistics

QUANTITIES = "src AS (SELECT l_returnflag AS g, CAST(l_quantity AS BIGINT) AS v FROM lineitem), h AS (SELECT g, v, CAST(count(*) AS BIGINT) AS c FROM src GROUP BY g, v)"


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_quantity").cast("long").alias("v0"))


@query(
    f"""WITH {QUANTITIES}, w AS (SELECT g, v, sum(v * c) OVER (PARTITION BY g ORDER BY v) AS upto, lead(v) OVER (PARTITION BY g ORDER BY v) AS nx,
    sum(v * c) OVER (PARTITION BY g) AS total FROM h)
    SELECT g, CAST(arg_min(CASE WHEN 2 * upto = total AND nx IS NOT NULL THEN (v + nx) // 2 ELSE v END, v) AS BIGINT) AS n50 FROM w WHERE 2 * upto >= total GROUP BY g"""
)
def n50_by_flag(spark, sf_dir):
    return nstats.n50(quantities(spark, sf_dir), "v0", ["g"])


@query(
    f"""WITH {QUANTITIES}, w AS (SELECT g, v, sum(v * c) OVER (PARTITION BY g ORDER BY v DESC) AS upto, sum(v * c) OVER (PARTITION BY g) AS total FROM h),
    l AS (SELECT CAST(unnest([10, 20, 30, 40, 50, 60, 70, 80, 90]) AS INT) AS level)
    SELECT g, level, CAST(max(v) AS BIGINT) AS n FROM w JOIN l ON upto > total * level // 100 GROUP BY g, level"""
)
def n_levels_by_flag(spark, sf_dir):
    return nstats.n_levels(quantities(spark, sf_dir), "v0", ["g"])


@query(
    f"""WITH {QUANTITIES}, w AS (SELECT g, v, c, sum(v * c) OVER (PARTITION BY g ORDER BY v) AS upto, coalesce(lag(v) OVER (PARTITION BY g ORDER BY v), 0) AS last,
    sum(v * c) OVER (PARTITION BY g) AS total FROM h),
    e AS (SELECT *, greatest(0, ceil((total / 2 - (upto - v * c)) / v) - 1) AS element FROM w WHERE 2 * upto >= total),
    s AS (SELECT g, v, CASE WHEN element > 0 THEN v ELSE last END AS low, (total / 2 - (upto - v * c) - element * v) / v AS share FROM e)
    SELECT g, CAST(arg_min(trunc((1 - share) * low + share * v), v) AS BIGINT) AS n50pl FROM s GROUP BY g"""
)
def n50_linear_by_flag(spark, sf_dir):
    return nstats.n_linear(quantities(spark, sf_dir), "v0", 0.5, ["g"])


@query("SELECT l_returnflag, round(sum(l_extendedprice * l_extendedprice) / sum(l_extendedprice), 4) AS weighted_mean FROM lineitem GROUP BY 1")
def length_weighted_mean(spark, sf_dir):
    rows = nstats.weighted_mean(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rows.withColumn("weighted_mean", F.round("weighted_mean", 4))


@query(
    """WITH b AS (SELECT l_returnflag, (floor(l_extendedprice / 1000) + 0.5) * 1000 AS m FROM lineitem)
    SELECT l_returnflag, round(sum(m * m) / sum(m), 4) AS weighted_mean FROM b GROUP BY 1"""
)
def binned_weighted_mean(spark, sf_dir):
    rows = nstats.binned_weighted_mean(table(spark, sf_dir, "lineitem"), "l_extendedprice", 1000, ["l_returnflag"])
    return rows.withColumn("weighted_mean", F.round("weighted_mean", 4))


@query("SELECT o_orderstatus, list_sort(list(o_totalprice))[CAST(count(*) // 2 + 1 AS BIGINT)] AS median FROM orders GROUP BY 1")
def upper_median(spark, sf_dir):
    return nstats.upper_median(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"])


@query("SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS sd FROM orders GROUP BY 1")
def mean_and_deviation(spark, sf_dir):
    rows = nstats.spread(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"])
    return rows.withColumns({"mean": F.round("mean", 4), "sd": F.round("sd", 4)})


@query(
    f"""WITH {QUANTITIES}, w AS (SELECT g, v, sum(c) OVER (PARTITION BY g ORDER BY v) AS upto, sum(c) OVER (PARTITION BY g) AS total FROM h),
    l AS (SELECT CAST(unnest([0.1, 0.5, 0.9]) AS DOUBLE) AS level)
    SELECT g, level, min(v) AS q FROM w JOIN l ON upto >= level * total GROUP BY g, level"""
)
def quantiles_by_flag(spark, sf_dir):
    return nstats.quantiles(quantities(spark, sf_dir), "v0", [0.1, 0.5, 0.9], ["g"])


@query(f"WITH {QUANTITIES} SELECT g, v, c, CAST(sum(c) OVER (PARTITION BY g ORDER BY v) AS BIGINT) AS upto, round(sum(c) OVER (PARTITION BY g ORDER BY v) / sum(c) OVER (PARTITION BY g), 9) AS share FROM h")
def distribution_by_flag(spark, sf_dir):
    return nstats.cumulative(quantities(spark, sf_dir), "v0", ["g"]).withColumn("share", F.round("share", 9))


# Aggregates


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2")
def distinct_with_multiplicity(spark, sf_dir):
    return aggregates.value_counts(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("WITH c AS (SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY 1) SELECT size, count(*) AS groups FROM c GROUP BY 1")
def reads_per_barcode_hist(spark, sf_dir):
    return aggregates.count_histogram(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("WITH m AS (SELECT min(o_totalprice) AS low FROM orders) SELECT o_orderstatus, round(low + floor((o_totalprice - low) / 10000) * 10000, 4) AS bin, count(*) AS n FROM orders, m GROUP BY 1, 2")
def binned_histogram(spark, sf_dir):
    return aggregates.binned(table(spark, sf_dir, "orders"), "o_totalprice", 10_000, ["o_orderstatus"]).withColumn("bin", F.round("bin", 4))


@query(
    """WITH c AS (SELECT event_type AS gem_group, user_id AS barcode, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT c_custkey AS barcode FROM customer WHERE c_custkey % 3 <> 0),
    t AS (SELECT gem_group, CAST(sum(CASE WHEN barcode NOT IN (SELECT barcode FROM w) THEN n ELSE 0 END) AS BIGINT) AS bad, sum(n) AS total FROM c GROUP BY 1)
    SELECT c.gem_group, c.barcode, c.n, t.bad, round(t.bad / t.total, 9) AS error_rate FROM c JOIN t USING (gem_group) WHERE c.barcode IN (SELECT barcode FROM w)"""
)
def barcode_counts(spark, sf_dir):
    reads = table(spark, sf_dir, "events").select(F.col("event_type").alias("gem_group"), F.col("user_id").alias("barcode"))
    listed = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("barcode"))
    return aggregates.barcode_counts(reads, listed).withColumn("error_rate", F.round("error_rate", 9))


@query(
    """WITH c AS (SELECT o_orderpriority AS barcode, count(*) AS n FROM orders GROUP BY 1), p AS (SELECT substr(barcode, 1, 1) AS lot, sum(n) AS n FROM c GROUP BY 1)
    SELECT arg_max(lot, n) AS lot, CAST(max(n) AS BIGINT) AS reads, CAST(sum(n) AS BIGINT) AS total,
    CASE WHEN sum(n) < 1000 THEN 'insufficient data' WHEN max(n) >= 0.95 * sum(n) THEN 'confident' ELSE 'ambiguous' END AS confidence FROM p"""
)
def lot_detection(spark, sf_dir):
    counts = aggregates.value_counts(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("barcode")), "barcode")
    lots = spark.createDataFrame([(str(i), str(i)) for i in range(10)], "prefix string, lot string")
    return aggregates.lot(counts, lots, prefix=1)


@query(f"WITH {I.CYCLES_SQL} SELECT mate, pos, q, count(*) AS n FROM cycles GROUP BY ALL")
def quality_histogram(spark, sf_dir):
    return aggregates.quality_counts(I.cycles(spark, sf_dir))


@query(
    f"""WITH {I.CYCLES_SQL} SELECT mate, pos, count(*) AS n, count(*) FILTER (WHERE q <= 26) AS n_low, round(count(*) FILTER (WHERE q <= 26) / count(*), 9) AS share
    FROM cycles GROUP BY ALL HAVING count(*) > 100 AND count(*) FILTER (WHERE q <= 26) / count(*) > 0.5"""
)
def bad_cycles(spark, sf_dir):
    hist = aggregates.quality_counts(I.cycles(spark, sf_dir))
    return aggregates.bad_cycles(hist, 100, 26).withColumn("share", F.round("share", 9))


@query(f"WITH {I.CYCLES_SQL} SELECT round(100 * count(*) FILTER (WHERE q >= 30) / count(*), 9) AS percent FROM cycles WHERE mate = 1")
def q30_share(spark, sf_dir):
    return aggregates.q_share(aggregates.quality_counts(I.cycles(spark, sf_dir))).select(F.round("percent", 9).alias("percent"))


@query(f"WITH {I.READS_SQL} SELECT round(100 * count(*) FILTER (WHERE barcode > 0) / count(*), 9) AS percent FROM reads")
def valid_barcode_percent(spark, sf_dir):
    return aggregates.valid_barcode_percent(I.reads(spark, sf_dir)).select(F.round("percent", 9).alias("percent"))


@query("SELECT count(*) AS reads, min(length(text)) AS shortest, max(length(text)) AS longest, CAST(sum(length(text)) AS BIGINT) AS bases, CAST(sum(CASE WHEN length(text) >= 48 THEN length(text) - 47 ELSE 0 END) AS BIGINT) AS kmers FROM documents")
def read_totals(spark, sf_dir):
    rows = aggregates.read_totals(table(spark, sf_dir, "documents"), F.length("text"))
    return rows.withColumns({c: F.col(c).cast("long") for c in rows.columns})


@query(
    """WITH c AS (SELECT user_id, count(*) AS n FROM events WHERE user_id > 0 GROUP BY 1), h AS (SELECT n AS v, count(*) AS c FROM c GROUP BY 1),
    w AS (SELECT v, sum(v * c) OVER (ORDER BY v) AS upto, lead(v) OVER (ORDER BY v) AS nx, sum(v * c) OVER () AS total FROM h)
    SELECT CAST(arg_min(CASE WHEN 2 * upto = total AND nx IS NOT NULL THEN (v + nx) // 2 ELSE v END, v) AS BIGINT) AS reads_n50,
    round((SELECT 100 * sum(CASE WHEN n >= 60 THEN n ELSE 0 END) / sum(n) FROM c), 9) AS big_percent FROM w WHERE 2 * upto >= total"""
)
def barcode_load(spark, sf_dir):
    return aggregates.barcode_load(table(spark, sf_dir, "events"), "user_id", 60).withColumn("big_percent", F.round("big_percent", 9))


@query(
    """WITH c AS (SELECT count(*) + 1 AS v FROM lineitem GROUP BY l_orderkey), r AS (SELECT v, sum(v) OVER (ORDER BY v DESC ROWS UNBOUNDED PRECEDING) - v AS before, sum(v) OVER () AS total FROM c),
    g AS (SELECT count(*) AS good FROM r WHERE before < total * 0.99 AND v >= 4) SELECT good, round(CASE WHEN good < 1000000 THEN -ln(1 - good / 1000000) * 1000000 ELSE 0 END, 4) AS partitions FROM g"""
)
def partition_occupancy(spark, sf_dir):
    counts = aggregates.value_counts(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return aggregates.occupancy(counts, 1_000_000).withColumn("partitions", F.round("partitions", 4))


@query(
    f"""WITH {I.PLACEMENTS_SQL} SELECT b.stop - a.start AS len, count(*) AS n FROM placements a JOIN placements b ON a.pair_id = b.pair_id AND a.edge = b.edge AND a.mate = 0 AND b.mate = 1
    WHERE a.start + 1000 <= a.edge_length AND b.stop - a.start BETWEEN 0 AND 1000 GROUP BY 1"""
)
def insert_sizes(spark, sf_dir):
    return aggregates.insert_sizes(I.placements(spark, sf_dir))


@query(
    f"""WITH {I.PLACEMENTS_SQL} SELECT round(100 * count(*) FILTER (WHERE b.stop - a.start BETWEEN 0 AND 1000) / count(*), 9) AS percent
    FROM (SELECT * FROM placements WHERE mate = 1) b LEFT JOIN (SELECT * FROM placements WHERE mate = 0) a ON a.pair_id = b.pair_id AND a.edge = b.edge"""
)
def proper_pair_percent(spark, sf_dir):
    return aggregates.proper_pair_percent(I.placements(spark, sf_dir)).select(F.round("percent", 9).alias("percent"))


@query(f"WITH {I.PLACEMENTS_SQL} SELECT DISTINCT edge, barcode FROM (SELECT edge, barcode FROM placements WHERE barcode > 0 UNION ALL SELECT rc_edge, barcode FROM placements WHERE barcode > 0)")
def edge_barcodes(spark, sf_dir):
    return aggregates.edge_barcodes(I.placements(spark, sf_dir))


@query(f"WITH {I.PATHS_SQL} SELECT unnest(edges) AS edge, read_id AS owner, CAST(unnest(range(len(edges))) AS INT) AS place FROM paths")
def edge_read_index(spark, sf_dir):
    return aggregates.inverted_index(I.paths(spark, sf_dir))


@query(f"WITH {I.PATHS_SQL}, e AS (SELECT unnest(edges) AS edge FROM paths) SELECT edge, least(count(*), 300) AS n FROM e GROUP BY 1")
def path_support(spark, sf_dir):
    return aggregates.support(I.paths(spark, sf_dir), most=300)


@query(f"WITH {I.PATHS_SQL}, e AS (SELECT unnest(edges) AS edge FROM paths) SELECT edge, count(*) AS n FROM e GROUP BY 1")
def edge_multiplicity(spark, sf_dir):
    return aggregates.support(I.paths(spark, sf_dir), most=1 << 62)


@query(f"WITH {I.PATHS_SQL}, e AS (SELECT unnest(edges[1:len(edges)-1]) AS a, unnest(edges[2:]) AS b FROM paths WHERE len(edges) > 1) SELECT a, b, count(*) AS n FROM e GROUP BY 1, 2")
def edge_bigrams(spark, sf_dir):
    return aggregates.bigrams(I.paths(spark, sf_dir))


@query(
    """WITH b AS (SELECT l_suppkey AS line, l_linenumber AS cell, CAST(l_quantity AS BIGINT) AS length FROM lineitem),
    r AS (SELECT line, cell, length, row_number() OVER (PARTITION BY line, cell ORDER BY length) AS r, count(*) OVER (PARTITION BY line, cell) AS n FROM b),
    m AS (SELECT line, length AS m FROM r WHERE r = n // 2 + 1) SELECT line, CAST(sum(m) AS BIGINT) AS length FROM m GROUP BY 1"""
)
def line_lengths(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("line"), F.col("l_linenumber").alias("cell"), F.col("l_quantity").cast("long").alias("length"))
    return aggregates.line_lengths(rows)


LINES_SQL = "lines AS (SELECT line, max(stop) AS length FROM spans GROUP BY 1)"


def lines(spark, sf_dir):
    return I.spans(spark, sf_dir).groupBy("line").agg(F.max("stop").alias("length"))


@query(
    f"""WITH {I.SPANS_SQL}, {LINES_SQL}, f AS (SELECT line, length, unnest([10000, 11000, 12100, 13310]) AS flank FROM lines),
    p AS (SELECT f.line, flank, sum(greatest(0, least(stop, flank) - greatest(start, 0)) + greatest(0, least(stop, length) - greatest(start, length - flank))) / (2.0 * flank) AS coverage
    FROM f JOIN spans USING (line) WHERE length >= 2 * flank GROUP BY 1, 2), m AS (SELECT flank, avg(coverage) AS mean FROM p GROUP BY 1)
    SELECT line, round(2 * avg(coverage / mean), 6) AS copies FROM p JOIN m USING (flank) WHERE mean > 0 GROUP BY 1"""
)
def copy_numbers(spark, sf_dir):
    rows = aggregates.copy_numbers(I.spans(spark, sf_dir), lines(spark, sf_dir), 10_000, 13_500)
    return rows.withColumn("copies", F.round("copies", 6))


@query(
    f"""WITH {I.SPANS_SQL}, {LINES_SQL}, r AS (SELECT line, sum(stop - start) AS bases, any_value(length) AS length FROM spans JOIN lines USING (line) GROUP BY 1)
    SELECT line, round(bases / length, 6) AS raw, round(bases / length / (SELECT sum(bases) / sum(length) FROM r), 6) AS normalised FROM r"""
)
def line_coverage(spark, sf_dir):
    rows = aggregates.coverage(I.spans(spark, sf_dir), lines(spark, sf_dir))
    return rows.withColumns({"raw": F.round("raw", 6), "normalised": F.round("normalised", 6)})


@query(
    f"""WITH src AS (SELECT l_returnflag AS kind, CAST(l_quantity AS BIGINT) AS v FROM lineitem), h AS (SELECT kind, v, count(*) AS c FROM src GROUP BY 1, 2),
    w AS (SELECT kind, v, c, sum(v * c) OVER (PARTITION BY kind ORDER BY v) AS upto, sum(v * c) OVER (PARTITION BY kind ORDER BY v DESC) AS down, lead(v) OVER (PARTITION BY kind ORDER BY v) AS nx, sum(v * c) OVER (PARTITION BY kind) AS total FROM h)
    SELECT kind, CAST(sum(c) AS BIGINT) AS n, CAST(any_value(total) AS BIGINT) AS total, max(v) AS longest,
    CAST(arg_min(CASE WHEN 2 * upto = total AND nx IS NOT NULL THEN (v + nx) // 2 ELSE v END, v) FILTER (WHERE 2 * upto >= total) AS BIGINT) AS n50,
    CAST(max(v) FILTER (WHERE down > total * 60 // 100) AS BIGINT) AS n60 FROM w GROUP BY kind"""
)
def assembly_report(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_quantity").cast("long").alias("length"))
    return aggregates.assembly_report(rows)


METRICS_SQL = """metrics AS (SELECT 'm_' || o_orderstatus AS name, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1),
    rules AS (SELECT * FROM (VALUES ('m_F', 10.0, '>', 'warn', 'many: {}'), ('m_O', 1e9, '<', 'warn', 'few: {}'), ('m_P', 1.0, '<', 'warn', 'none'), ('m_F', 1e9, '>', 'warn', 'no')) AS r(metric, threshold, compare, action, text))"""


@query(
    f"""WITH {METRICS_SQL} SELECT metric, value, action, CASE WHEN text LIKE '%{{}}' THEN replace(text, '{{}}', CAST(value AS VARCHAR)) ELSE text END AS text
    FROM metrics JOIN rules ON name = metric WHERE (compare = '>') <> (value < threshold)"""
)
def metrics_alerts(spark, sf_dir):
    metrics = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("m_"), "o_orderstatus").alias("name")).agg(F.count("*").cast("double").alias("value"))
    rules = [("m_F", 10.0, ">", "warn", "many: {}"), ("m_O", 1e9, "<", "warn", "few: {}"), ("m_P", 1.0, "<", "warn", "none"), ("m_F", 1e9, ">", "warn", "no")]
    return aggregates.alerts(metrics, spark.createDataFrame(rules, "metric string, threshold double, compare string, action string, text string"))


@query(
    """WITH c AS (SELECT CASE WHEN user_id % 4 = 0 THEN '0_0_0' ELSE CAST(user_id AS VARCHAR) END AS barcode, count(*) AS n FROM events GROUP BY 1)
    SELECT count(*) FILTER (WHERE barcode <> '0_0_0') AS types, round(100.0 * count(*) FILTER (WHERE barcode <> '0_0_0') / 10000, 9) AS types_percent, CAST(sum(n) AS BIGINT) AS pairs,
    round(100.0 * sum(CASE WHEN barcode <> '0_0_0' THEN n ELSE 0 END) / sum(n), 9) AS split_percent FROM c"""
)
def split_statistics(spark, sf_dir):
    reads = table(spark, sf_dir, "events").select(F.when(F.col("user_id") % 4 == 0, "0_0_0").otherwise(F.col("user_id").cast("string")).alias("barcode"))
    rows = aggregates.split_statistics(reads, possible=10_000)
    return rows.withColumns({"types_percent": F.round("types_percent", 9), "split_percent": F.round("split_percent", 9)})


@query("SELECT event_type, CAST(floor(value) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1, 2")
def merged_histograms(spark, sf_dir):
    parts = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 4).alias("chunk"), F.floor("value").alias("bin")).agg(F.count("*").alias("n"))
    return aggregates.merged_histograms(parts, "event_type", "bin")


# Duplicates


@query(
    f"""WITH {I.READS_OF_ORDERS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY barcode, seq1, seq2 ORDER BY quals1[1] + quals2[1] DESC, pair_id) AS r FROM pairs)
    SELECT pair_id, barcode, seq1, seq2 FROM r WHERE r = 1 OR barcode IS NULL OR barcode <= 0"""
)
def predup_best(spark, sf_dir):
    return dedup.predup(I.pairs(spark, sf_dir)).select("pair_id", "barcode", "seq1", "seq2")


KEY = ", ".join(dedup.ALIGNMENT_KEY)


@query(
    f"""WITH {I.ALIGNMENTS_SQL} SELECT qname, x, y, mapped AND row_number() OVER (PARTITION BY {KEY}, mapped ORDER BY qname, x, y) > 1 AS is_duplicate FROM alignments"""
)
def dup_mark(spark, sf_dir):
    rows = dedup.mark_duplicates(I.alignments(spark, sf_dir), order=("qname", "x", "y"), mapped=F.col("mapped"))
    return rows.select("qname", "x", "y", "is_duplicate")


@query(
    f"""WITH {I.ALIGNMENTS_SQL}, c AS (SELECT unnest(['all', 'perfect']) AS reads), b AS (SELECT unnest([true, false]) AS use_barcode),
    g AS (SELECT c.reads, b.use_barcode, CASE WHEN b.use_barcode THEN barcode END AS bc, is_read1, is_reverse, tid, pos, mate_tid, mate_pos, count(*) AS size
    FROM alignments, c, b WHERE c.reads = 'all' OR perfect GROUP BY ALL) SELECT reads, use_barcode, 1.0::DOUBLE AS rate_kept, size, count(*) AS groups FROM g GROUP BY 1, 2, 4"""
)
def dup_summary(spark, sf_dir):
    return dedup.summary(I.alignments(spark, sf_dir), perfect=F.col("perfect"))


@query(f"WITH {I.ALIGNMENTS_SQL}, g AS (SELECT count(*) AS size FROM alignments GROUP BY {KEY}) SELECT round(sum(size - 1) / sum(size), 9) AS rate FROM g")
def dup_rate(spark, sf_dir):
    return dedup.duplicate_rate(dedup.group_sizes(I.alignments(spark, sf_dir))).select(F.round("rate", 9).alias("rate"))


@query(
    f"""WITH {I.ALIGNMENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY qname, x, y) AS r FROM alignments),
    d AS (SELECT sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM r a JOIN r b USING ({KEY}, lane) WHERE a.r <= 100 AND a.r < b.r)
    SELECT CASE WHEN d < 100 THEN 'optical' ELSE 'diffusion' END AS kind, CAST(floor(d) AS BIGINT) AS distance, count(*) AS n FROM d WHERE d < 25000 AND EXISTS (SELECT 1 FROM d WHERE d < 100) GROUP BY 1, 2"""
)
def proximal_duplicates(spark, sf_dir):
    return dedup.proximal(I.alignments(spark, sf_dir), order=("qname", "x", "y"))


# Joins


@query("SELECT e.event_id, e.user_id, c.c_nationkey AS place FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id * 20")
def whitelist_lookup(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("place"))
    reads = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("user_id") * 20).alias("key"))
    return joins.whitelist_lookup(reads, listed, "key").drop("key")


SEGMENTS_SQL = """segments AS (SELECT substr(seq, 1, 4) AS segment, CAST(min(read_id) AS INT) AS barcode_id FROM items WHERE substr(seq, 1, 4) NOT LIKE '%N%' AND length(seq) > 40 GROUP BY 1),
    words AS (SELECT segment AS word, barcode_id FROM segments UNION ALL SELECT substr(segment, 1, CAST(i AS INT) - 1) || c || substr(segment, CAST(i AS INT) + 1), barcode_id
    FROM segments, (SELECT unnest([1, 2, 3, 4]) AS i), (SELECT unnest(['A', 'C', 'G', 'T']) AS c) WHERE substr(segment, CAST(i AS INT), 1) <> c), expanded AS (SELECT word, max(barcode_id) AS n FROM words GROUP BY 1)"""


def segments(spark, sf_dir):
    rows = I.items(spark, sf_dir).where("length(seq) > 40").select(F.substring("seq", 1, 4).alias("segment"), F.col("read_id"))
    return rows.where("not segment like '%N%'").groupBy("segment").agg(F.min("read_id").cast("int").alias("barcode_id"))


@query(
    f"""WITH {I.READS_SQL}, {I.ITEMS_SQL}, {SEGMENTS_SQL} SELECT read_id, CASE WHEN a.n IS NULL OR b.n IS NULL OR c.n IS NULL THEN '0_0_0' ELSE concat(a.n, '_', b.n, '_', c.n) END AS barcode
    FROM reads LEFT JOIN expanded a ON a.word = substr(seq, 11, 4) LEFT JOIN expanded b ON b.word = substr(seq, 17, 4) LEFT JOIN expanded c ON c.word = substr(seq, 23, 4)"""
)
def demultiplexed_reads(spark, sf_dir):
    reads = I.reads(spark, sf_dir).select("read_id", "seq")
    return joins.demultiplex(reads, segments(spark, sf_dir), start=10, offsets=(0, 6, 12), width=4).select("read_id", "barcode")


@query()
def corrected_barcodes(spark, sf_dir):
    """Barcodes of six bases, corrected against those that occur often; tested by brute force."""
    reads = I.reads(spark, sf_dir).where("length(seq) >= 6").select("read_id", F.substring("seq", 1, 6).alias("raw"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: ((F.col("read_id") * i) % 40).cast("int")).alias("quals"))
    often = aggregates.value_counts(reads.where("not raw like '%N%'").select(F.col("raw").alias("barcode")), "barcode").where("n >= 3")
    return joins.correct_barcodes(reads, often)


OWNERS_SQL = "owners AS (SELECT DISTINCT l_suppkey AS owner, l_orderkey AS item FROM lineitem)"


def owners(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS owner", "l_orderkey AS item").distinct()


PAIRS_SQL = f"""{OWNERS_SQL}, sizes AS (SELECT owner, count(*) AS n FROM owners GROUP BY 1), common AS (SELECT x.owner AS a, y.owner AS b, count(*) AS common FROM owners x JOIN owners y USING (item)
    WHERE x.owner < y.owner GROUP BY 1, 2), pairs AS (SELECT a, b, common, s.n AS size_a, t.n AS size_b, common / (s.n + t.n - common) AS jaccard FROM common JOIN sizes s ON s.owner = a JOIN sizes t ON t.owner = b)"""


@query(f"WITH {PAIRS_SQL} SELECT a, b, common, size_a, size_b, round(jaccard, 9) AS jaccard FROM pairs")
def jaccard_pairs(spark, sf_dir):
    return joins.overlap_pairs(owners(spark, sf_dir)).withColumn("jaccard", F.round("jaccard", 9))


@query(
    f"""WITH {PAIRS_SQL}, both_ AS (SELECT a AS owner, b AS neighbour, common FROM pairs UNION ALL SELECT b, a, common FROM pairs), m AS (SELECT *, max(common) OVER (PARTITION BY owner) AS best FROM both_ WHERE common >= 6)
    SELECT owner, neighbour, common FROM m WHERE common / best >= 0.1"""
)
def neighbour_cut(spark, sf_dir):
    return joins.neighbour_cut(joins.overlap_pairs(owners(spark, sf_dir)))


@query(
    """WITH l AS (SELECT DISTINCT l_suppkey AS s, l_partkey % 300 AS p FROM lineitem), a AS (SELECT s, list(p) AS ps FROM l GROUP BY 1)
    SELECT x.s AS a, y.s AS b, CAST(len(list_intersect(x.ps, y.ps)) AS INT) AS meet, len(list_intersect(x.ps, y.ps)) = 0 AS disjoint FROM a x JOIN a y ON y.s = x.s + 1"""
)
def sorted_set_meet(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s")).agg(F.collect_set(F.col("l_partkey") % 300).alias("ps"))
    x, y = rows.select(F.col("s").alias("a"), F.col("ps").alias("x")), rows.select(F.col("s").alias("b"), F.col("ps").alias("y"), (F.col("s") - 1).alias("a"))
    return x.join(y, "a").select("a", "b", sets.meet_size(F.col("x"), F.col("y")).alias("meet"), sets.disjoint(F.col("x"), F.col("y")).alias("disjoint"))


TERMS_SQL = "terms AS (SELECT o_orderkey AS id, o_custkey % 50 AS g, CAST(floor(epoch(o_orderdate)) AS BIGINT) // 86400 AS start, CAST(floor(epoch(o_orderdate)) AS BIGINT) // 86400 + 1 + o_custkey % 9 AS stop FROM orders)"


def terms(spark, sf_dir):
    day = F.floor(F.unix_timestamp("o_orderdate") / 86_400)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).alias("g"), day.alias("start"), (day + 1 + F.col("o_custkey") % 9).alias("stop"))


@query(f"WITH {TERMS_SQL} SELECT a.id AS l_id, b.id AS r_id FROM terms a JOIN terms b ON a.g = b.g AND a.start < b.stop AND b.start < a.stop AND a.id < b.id")
def interval_overlap(spark, sf_dir):
    rows = terms(spark, sf_dir)
    return joins.interval_join(rows, rows, 8, ["g"]).where("l_id < r_id").select("l_id", "r_id")


@query(
    f"""WITH {TERMS_SQL}, p AS (SELECT event_id, user_id AS g, CAST(floor(epoch(ts)) AS BIGINT) // 86400 - 9000 AS pos FROM events)
    SELECT event_id, id FROM p JOIN terms ON p.g = terms.g AND pos >= start AND pos < stop"""
)
def points_in_intervals(spark, sf_dir):
    points = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("g"), (F.floor(F.unix_timestamp("ts") / 86_400) - 9000).alias("pos"))
    return joins.point_join(points, terms(spark, sf_dir), 8, "pos", ["g"]).select("event_id", "id")


@query(
    """WITH t AS (SELECT s_acctbal AS k, min(s_suppkey) AS r FROM supplier GROUP BY 1), d AS (SELECT c_custkey, k, r, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - k), k) AS n FROM customer, t)
    SELECT c_custkey, r FROM d WHERE n = 1"""
)
def nearest_calibration(spark, sf_dir):
    entries = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("k"), F.col("s_suppkey").alias("r"))
    return joins.nearest(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), entries, "c_acctbal", "k", "r").select("c_custkey", "r")


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id)")
def zipped_streams(spark, sf_dir):
    return joins.zip_streams(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


# k-mers


@query(
    f"""WITH {I.READS_SQL}, called AS (SELECT barcode, translate(seq, 'N', 'A') AS s FROM reads WHERE length(seq) >= 13),
    k AS (SELECT barcode, unnest(list_transform(range(1, length(s) - 10), lambda i: substr(s, i, 12))) AS k FROM called),
    c AS (SELECT barcode, least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer FROM k) SELECT kmer, count(*) AS n, count(DISTINCT CASE WHEN barcode > 0 THEN barcode END) AS barcodes FROM c GROUP BY 1
    HAVING count(*) >= 3 AND count(DISTINCT CASE WHEN barcode > 0 THEN barcode END) >= 2"""
)
def kmer_count(spark, sf_dir):
    return kmers.count(I.reads(spark, sf_dir).withColumn("seq", S.n_to_a("seq")), 12).select("kmer", "n", "barcodes")


@query(
    f"""WITH {I.READS_SQL}, k AS (SELECT unnest(list_transform(range(1, length(seq) - 6), lambda i: substr(seq, i, 8))) AS k FROM reads WHERE length(seq) >= 8),
    c AS (SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM k GROUP BY 1) SELECT n AS count, count(*) AS kmers FROM c GROUP BY 1"""
)
def kmer_spectrum(spark, sf_dir):
    rows = kmers.canonical_kmers(I.reads(spark, sf_dir), 8)
    return kmers.spectrum(aggregates.value_counts(rows, "kmer"))


@query(
    f"""WITH {I.ITEMS_SQL}, k AS (SELECT read_id, CAST(i - 1 AS INT) AS pos, substr(seq, i, 25) AS k FROM (SELECT read_id, seq, unnest(range(1, length(seq) - 23)) AS i FROM items WHERE length(seq) >= 25)),
    c AS (SELECT read_id, pos, CASE WHEN translate(k, 'ACTG', '0123') >= translate(reverse(translate(k, 'ACGT', 'TGCA')), 'ACTG', '0123') THEN reverse(translate(k, 'ACGT', 'TGCA')) ELSE k END AS kmer,
    translate(k, 'ACTG', '0123') >= translate(reverse(translate(k, 'ACGT', 'TGCA')), 'ACTG', '0123') AS is_rev FROM k)
    SELECT kmer, any_value(read_id) AS read_id, any_value(pos) AS contig_pos, any_value(is_rev) AS contig_rev FROM c GROUP BY 1 HAVING count(*) = 1"""
)
def unique_anchors(spark, sf_dir):
    return kmers.unique_anchors(I.items(spark, sf_dir), 25, owner="read_id")


@query(
    f"""WITH {I.ITEMS_SQL}, k AS (SELECT unnest(list_transform(range(1, length(seq) - 23), lambda i: substr(seq, i, 25))) AS k FROM items WHERE length(seq) >= 25),
    c AS (SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM k GROUP BY 1) SELECT count(*) AS total, count(*) FILTER (WHERE n = 1) AS "unique" FROM c"""
)
def anchor_statistics(spark, sf_dir):
    return kmers.anchor_statistics(I.items(spark, sf_dir), 25)


@query(
    f"""WITH {I.READS_SQL}, {I.ITEMS_SQL}, d AS (SELECT read_id AS edge, CAST(i - 1 AS INT) AS off, substr(seq, i, 20) AS kmer FROM (SELECT read_id, seq, unnest(range(1, length(seq) - 18)) AS i FROM items WHERE length(seq) >= 20)),
    u AS (SELECT kmer, min(edge) AS edge, min(off) AS off FROM d GROUP BY 1 HAVING count(*) = 1), h AS (SELECT read_id, edge, off, CAST(i - 1 AS INT) AS pos FROM
    (SELECT read_id, i, substr(seq, i, 20) AS kmer FROM (SELECT read_id, seq, unnest(range(1, length(seq) - 18)) AS i FROM reads WHERE length(seq) >= 20)) JOIN u USING (kmer)),
    r AS (SELECT read_id, edge, off - pos AS g, min(pos) AS start, max(pos) + 20 AS stop, min(off) AS "offset", count(*) AS kmers FROM h GROUP BY 1, 2, 3)
    SELECT read_id, edge, start, stop, "offset", kmers, CAST(row_number() OVER (PARTITION BY read_id ORDER BY start, edge, g) - 1 AS INT) AS ordinal FROM r"""
)
def read_paths(spark, sf_dir):
    places = kmers.exploded(I.items(spark, sf_dir), 20, "seq", "read_id")
    unique = places.groupBy("kmer").agg(F.count("*").alias("n"), F.min("read_id").alias("edge"), F.min("pos").alias("offset")).where("n = 1").drop("n")
    return kmers.paths_of(I.reads(spark, sf_dir), unique, 20)


@query(
    f"""WITH {I.ITEMS_SQL}, k AS (SELECT DISTINCT read_id, unnest(list_transform(range(1, length(seq) - 6), lambda i: least(substr(seq, i, 8), reverse(translate(substr(seq, i, 8), 'ACGT', 'TGCA'))))) AS kmer FROM items WHERE length(seq) >= 8),
    f AS (SELECT *, count(*) OVER (PARTITION BY kmer) AS n FROM k) SELECT x.read_id AS a, y.read_id AS b, count(*) AS common FROM f x JOIN f y USING (kmer) WHERE x.n <= 10 AND y.n <= 10 AND x.read_id < y.read_id GROUP BY 1, 2"""
)
def friend_reads(spark, sf_dir):
    return kmers.friends(I.items(spark, sf_dir), 8, 10)


@query(
    f"""WITH {I.READS_SQL}, {I.ITEMS_SQL}, t AS (SELECT read_id AS target, CAST(i - 1 AS INT) AS tpos, substr(seq, i, 20) AS kmer FROM (SELECT read_id, seq, unnest(range(1, length(seq) - 18)) AS i FROM items WHERE length(seq) >= 20)),
    u AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY kmer) AS n FROM t) WHERE n <= 100), r AS (SELECT read_id, CAST(i - 1 AS INT) AS pos, substr(seq, i, 20) AS kmer FROM
    (SELECT read_id, seq, unnest(range(1, length(seq) - 18)) AS i FROM reads WHERE length(seq) >= 20))
    SELECT read_id, target, tpos - pos AS diagonal, count(*) AS kmers, min(tpos) AS start, max(tpos) + 20 AS stop FROM r JOIN u USING (kmer) GROUP BY 1, 2, 3 HAVING count(*) >= 2"""
)
def genome_diagonals(spark, sf_dir):
    return kmers.diagonals(I.reads(spark, sf_dir), I.items(spark, sf_dir).select(F.col("read_id").alias("target"), "seq"), 20)


# Windows


@query(
    f"""WITH {I.POINTS_SQL}, s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY line, barcode ORDER BY pos, pair_id) > 20000 THEN 1 ELSE 0 END AS n FROM points)
    SELECT line, barcode, pos, pair_id, CAST(sum(n) OVER (PARTITION BY line, barcode ORDER BY pos, pair_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM s"""
)
def molecule_sessions(spark, sf_dir):
    return windows.sessions(I.points(spark, sf_dir), ["line", "barcode"], F.col("pos"), 20_000, "pair_id")


@query(
    f"""WITH {I.POINTS_SQL}, lines AS (SELECT line, max(pos) + 60000 AS length FROM points GROUP BY 1), s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY line, barcode ORDER BY pos, pair_id) > 20000 THEN 1 ELSE 0 END AS n FROM points),
    t AS (SELECT *, sum(n) OVER (PARTITION BY line, barcode ORDER BY pos, pair_id ROWS UNBOUNDED PRECEDING) AS session FROM s),
    m AS (SELECT line, barcode, CAST(session AS BIGINT) AS session, count(DISTINCT pair_id) - 1 AS pairs, min(pos) AS start, max(pos) AS stop FROM t GROUP BY 1, 2, 3 HAVING count(DISTINCT pair_id) >= 5)
    SELECT line, barcode, session, pairs, start, stop, CAST(floor((pairs + 1) / (pairs - 1) * (stop - start)) AS BIGINT) AS length FROM m JOIN lines USING (line)
    WHERE floor((pairs + 1) / (pairs - 1) * (stop - start)) > 1000 AND lines.length > 1000 AND start > 20000 AND lines.length - stop > 20000"""
)
def molecules(spark, sf_dir):
    points = I.points(spark, sf_dir)
    ends = points.groupBy("line").agg((F.max("pos") + 60_000).alias("length"))
    return windows.molecules(points, ends, 20_000)


@query(
    f"""WITH {I.POINTS_SQL}, s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY line, barcode ORDER BY pos) > 100000 THEN 1 ELSE 0 END AS n FROM points),
    t AS (SELECT *, sum(n) OVER (PARTITION BY line, barcode ORDER BY pos ROWS UNBOUNDED PRECEDING) AS session FROM s)
    SELECT line, barcode, count(*) AS reads, min(pos) - 25000 AS start, max(pos) + 25000 AS stop FROM t GROUP BY line, barcode, session HAVING count(*) >= 3"""
)
def territory_groups(spark, sf_dir):
    return windows.territories(I.points(spark, sf_dir))


@query(
    f"""WITH {I.POINTS_SQL}, r AS (SELECT line AS ordering, barcode, pos, pair_id % 13 AS li, pos - lag(pos) OVER w AS step, pair_id % 13 > lag(pair_id % 13) OVER w AS rises FROM points WINDOW w AS (PARTITION BY line, barcode ORDER BY pos, pair_id)),
    m AS (SELECT *, avg(step) OVER (PARTITION BY ordering, barcode) AS mean FROM r) SELECT ordering, round(sum(CASE WHEN rises AND mean > 0 AND step / mean >= 2 THEN step / mean ELSE 0 END), 5) AS score FROM m GROUP BY 1"""
)
def order_score(spark, sf_dir):
    return windows.order_score(I.points(spark, sf_dir).select(F.col("line").alias("ordering"), "barcode", "pos", (F.col("pair_id") % 13).alias("line_index"))).withColumn("score", F.round("score", 5))


@query(
    f"""WITH {I.POINTS_SQL}, mids AS (SELECT line, unnest(range(min(pos), max(pos), 86400)) AS middle FROM points GROUP BY 1),
    s AS (SELECT mids.line, middle, barcode, max(CASE WHEN pos - middle BETWEEN -43200 AND -600 THEN 1 ELSE 0 END) AS l, max(CASE WHEN pos - middle BETWEEN 600 AND 43200 THEN 1 ELSE 0 END) AS r
    FROM mids JOIN points ON mids.line = points.line AND pos BETWEEN middle - 43200 AND middle + 43200 WHERE abs(pos - middle) >= 600 GROUP BY 1, 2, 3)
    SELECT line, middle, CAST(sum(l) AS BIGINT) AS "left", CAST(sum(r) AS BIGINT) AS "right", CAST(sum(l * r) AS BIGINT) AS bridges FROM s GROUP BY 1, 2"""
)
def bridging_barcodes(spark, sf_dir):
    points = I.points(spark, sf_dir)
    mids = points.groupBy("line").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).select("line", F.explode(F.sequence("a", F.col("b") - 1, F.lit(86_400).cast("long"))).alias("middle"))
    return windows.bridging(points, mids, 43_200, 600)


@query(
    f"""WITH {I.READS_SQL}, p AS (SELECT read_id, unnest(regexp_extract_all(seq, 'N+|[^N]+')) AS p, unnest(range(len(regexp_extract_all(seq, 'N+|[^N]+')))) AS i FROM reads),
    w AS (SELECT read_id, p, sum(length(p)) OVER (PARTITION BY read_id ORDER BY i) AS stop FROM p) SELECT read_id, CAST(stop - length(p) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM w WHERE p LIKE 'N%' AND length(p) >= 3"""
)
def n_runs(spark, sf_dir):
    return windows.character_runs(I.reads(spark, sf_dir), ["read_id"], "seq", "Nn", 3)


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 3600 AS h FROM events), g AS (SELECT user_id, h, h - row_number() OVER (PARTITION BY user_id ORDER BY h) AS i FROM d)
    SELECT user_id, min(h) AS start, max(h) + 1 AS stop FROM g GROUP BY user_id, i"""
)
def run_segments(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 3600).alias("h")).distinct()
    return windows.runs(hours, ["user_id"], "h", F.lit(True))


@query(
    """SELECT event_id, min(value) OVER w AS value_min, max(value) OVER w AS value_max, round(sum(value) OVER w, 4) AS value_sum, round(avg(value) OVER w, 6) AS value_mean
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)"""
)
def rolling_window_stats(spark, sf_dir):
    rows = windows.rolling(table(spark, sf_dir, "events"), "value", ["ts", "event_id"], 5, ["user_id"])
    return rows.select("event_id", "value_min", "value_max", F.round("value_sum", 4).alias("value_sum"), F.round("value_mean", 6).alias("value_mean"))


@query("SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS upto FROM orders")
def cumulative_sums(spark, sf_dir):
    rows = windows.cumulative_sum(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderdate", "o_orderkey"], ["o_custkey"])
    return rows.select("o_orderkey", "o_custkey", F.round("o_totalprice_upto", 2).alias("upto"))


@query()
def peak_days(spark, sf_dir):
    """Peaks of line counts by ship day; tested on small curves."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.datediff("l_shipdate", F.lit("1990-01-01")).cast("double").alias("x"), "l_returnflag").agg(F.count("*").cast("double").alias("y"))
    return windows.peaks(days, ["l_returnflag"], spread=0.002)


# Orders, buckets, samples


@query("SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1 AS INT) AS place FROM orders")
def sort_permutation(spark, sf_dir):
    return sorting.sort_permutation(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey", by=["o_orderstatus"]).select("o_orderkey", "place")


@query("SELECT c_custkey, substr(c_mktsegment, 1, 2) AS bucket FROM customer")
def prefix_buckets(spark, sf_dir):
    return sorting.bucket_by_prefix(table(spark, sf_dir, "customer"), "c_mktsegment", 2, "c_name").select("c_custkey", "bucket")


@query()
def range_buckets(spark, sf_dir):
    """Orders in ranges of customers; equal customers share a bucket."""
    return sorting.bucket_by_range(table(spark, sf_dir, "orders"), 16, "o_custkey").select("o_orderkey", "o_custkey", "bucket")


@query(
    """WITH RECURSIVE l AS (SELECT o_orderkey AS line, CAST(floor(o_totalprice) AS BIGINT) AS length FROM orders),
    w AS (SELECT line, length, row_number() OVER o AS n, CAST(sum(length) OVER o AS BIGINT) - length AS before FROM l WINDOW o AS (ORDER BY length DESC, line ROWS UNBOUNDED PRECEDING)),
    b AS (SELECT CAST(0 AS BIGINT) AS bucket, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS before
      UNION ALL SELECT b.bucket + 1, min(w.n), min(w.before) FROM b JOIN w ON w.before >= b.before + 1000000 GROUP BY b.bucket)
    SELECT line, length, bucket FROM w ASOF JOIN b ON w.n >= b.n"""
)
def balanced_buckets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"), F.floor("o_totalprice").alias("length"))
    return sorting.balanced_buckets(rows, 1_000_000)


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def top_k_per_group(spark, sf_dir):
    return sorting.top(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_orderkey")


@query("SELECT * FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) < 4)")
def max_reads_per_group(spark, sf_dir):
    return sorting.max_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 4)


@query()
def sampled_pairs(spark, sf_dir):
    """Both lines of a tenth of the orders, by hash; a sample is the feature."""
    return sorting.sample_pairs(table(spark, sf_dir, "lineitem"), 0.1, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("SELECT doc_id, substr(text, 11) AS seq FROM documents")
def trimmed_reads(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.trim("text", 10).alias("seq"))


# Sets


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf_dir):
    return sets.union_distinct(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def intersection(spark, sf_dir):
    return sets.intersection(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "events").select(F.col("user_id").alias("k")))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def unlinked(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return sets.difference(rows, table(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def members(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return sets.members(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), big, "p_partkey")


CONTAINED_SQL = """names AS (SELECT p_partkey AS name FROM part), sized AS (SELECT x.p_partkey AS x, y.p_partkey AS y, x.p_size AS x_size, y.p_size AS y_size FROM part x JOIN part y ON y.p_partkey = (x.p_partkey + 2) // 3),
    edges AS (SELECT x AS a, y AS b FROM sized WHERE x_size <= y_size UNION SELECT y, x FROM sized WHERE x_size = y_size)"""
REACH_SQL = f"RECURSIVE {CONTAINED_SQL}, reach AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)"


def contained(spark, sf_dir):
    """A part lies within the part of a third of its number if that is as large, and also the other way if they are equal."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    x, y = parts.toDF("x", "x_size").withColumn("y", F.expr("(x + 2) div 3")), parts.toDF("y", "y_size")
    sized = x.join(y, "y")
    return sized.where("x_size <= y_size").selectExpr("x AS a", "y AS b").union(sized.where("x_size = y_size").selectExpr("y AS a", "x AS b"))


@query(f"WITH {REACH_SQL} SELECT a, b FROM reach WHERE a <> b")
def transitive_closure(spark, sf_dir):
    return sets.closure(contained(spark, sf_dir))


@query(
    f"""WITH {REACH_SQL}, mutual AS (SELECT r.a, r.b FROM reach r JOIN reach s ON r.a = s.b AND r.b = s.a WHERE r.a <> r.b), strict AS (SELECT a, b FROM reach WHERE a <> b EXCEPT SELECT a, b FROM mutual)
    SELECT name FROM names WHERE name NOT IN (SELECT a FROM strict) AND name NOT IN (SELECT a FROM mutual WHERE b < a)"""
)
def redundancy_filter(spark, sf_dir):
    return sets.maximal(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name")), contained(spark, sf_dir))


# Scalars


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber * 2362369 + (l_partkey % 1537) * 1537 + l_suppkey % 1537 AS barcode, (CAST(l_linenumber AS BIGINT) << 40) | ((l_partkey % 1537) << 20) | (l_suppkey % 1537) AS packed FROM lineitem")
def barcode_encode(spark, sf_dir):
    text = F.concat_ws("_", F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 1537).cast("string"), (F.col("l_suppkey") % 1537).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.barcode_id(text).alias("barcode"), S.packed_barcode(text).alias("packed"))


@query(f"WITH {I.READS_SQL} SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, translate(seq, 'N', 'A') AS called FROM reads")
def reverse_complements(spark, sf_dir):
    return I.reads(spark, sf_dir).select("read_id", S.reverse_complement("seq").alias("rc"), S.n_to_a("seq").alias("called"))


@query(
    f"""WITH {I.READS_SQL}, w AS (SELECT read_id, translate(seq, 'N', 'A') AS seq, unnest(range(1, length(seq) - 19)) AS i FROM reads WHERE length(seq) >= 21), k AS (SELECT read_id, substr(seq, i, 21) AS k FROM w),
    c AS (SELECT read_id, least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS canonical, k >= reverse(translate(k, 'ACGT', 'TGCA')) AS is_rev,
    CAST(list_sum(list_transform(range(1, 22), lambda i: CAST(translate(substr(k, i, 1), 'ACTG', '0123') AS BIGINT) << (2 * (21 - i)))) AS BIGINT) AS code, substr(k, 2) || 'C' AS next, 'G' || substr(k, 1, 20) AS previous FROM k)
    SELECT read_id, count(*) AS kmers, count(*) FILTER (WHERE is_rev) AS reversed, min(canonical) AS first_canonical, max(canonical) AS last_canonical, CAST(sum(code % 1000003) AS BIGINT) AS codes, max(next) AS last_next, min(previous) AS first_previous
    FROM c GROUP BY 1"""
)
def canonical_kmer(spark, sf_dir):
    """All 21-mers of every read, a row a read."""
    return kmers.summary(I.reads(spark, sf_dir).withColumn("seq", S.n_to_a("seq")), 21, "read_id")


@query(
    f"""WITH {I.READS_SQL}, b AS (SELECT read_id, translate(seq, 'ACGTN', '11110') AS b FROM reads) SELECT read_id, CAST(length(regexp_extract(b, '^(.*11111)', 1)) AS INT) AS good FROM b"""
)
def good_length(spark, sf_dir):
    quals = F.transform(F.filter(F.split("seq", ""), lambda c: c != ""), lambda c: F.when(c == "N", 2).otherwise(30))
    return I.reads(spark, sf_dir).select("read_id", S.good_length(quals, 5, 7).alias("good"))


@query(
    """SELECT o_orderkey, CAST(o_custkey % 50 + o_orderkey % 30 AS BIGINT) AS reference, CAST(o_custkey % 50 + o_orderkey % 7 AS BIGINT) AS query,
    concat(CAST(o_orderkey % 30 AS VARCHAR), 'D', CAST(o_orderkey % 7 AS VARCHAR), 'I', CAST(o_custkey % 50 AS VARCHAR), 'M') AS reversed FROM orders"""
)
def cigar_lengths(spark, sf_dir):
    part = lambda c, k: F.concat(c.cast("string"), F.lit(k))
    cigar = F.concat(part(F.col("o_custkey") % 50, "M"), part(F.col("o_orderkey") % 7, "I"), part(F.col("o_orderkey") % 30, "D"))
    return table(spark, sf_dir, "orders").select("o_orderkey", N.reference_length(cigar).alias("reference"), N.query_length(cigar).alias("query"), N.cigar_reverse(cigar).alias("reversed"))


@query(
    f"""WITH {TERMS_SQL}, t AS (SELECT *, lead(start) OVER (PARTITION BY g ORDER BY start, id) AS s2, lead(stop) OVER (PARTITION BY g ORDER BY start, id) AS e2 FROM terms)
    SELECT id, greatest(0, least(stop, e2) - greatest(start, s2)) AS overlap, greatest(0, greatest(start, s2) - least(stop, e2)) AS gap, start <= s2 AND e2 <= stop AS contains, (start + stop) // 2 AS middle FROM t WHERE s2 IS NOT NULL"""
)
def interval_scalars(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("g").orderBy("start", "id")
    rows = terms(spark, sf_dir).withColumns({"s2": F.lead("start").over(order), "e2": F.lead("stop").over(order)}).where("s2 is not null")
    of = [F.col(c) for c in ("start", "stop", "s2", "e2")]
    return rows.select("id", N.overlap(*of).alias("overlap"), N.gap_between(*of).alias("gap"), N.contains(*of).alias("contains"), N.midpoint("start", "stop").alias("middle"))


@query(
    """WITH p AS (SELECT vec_id, embedding AS a, lead(embedding) OVER (ORDER BY vec_id) AS b FROM embeddings)
    SELECT vec_id, round(list_dot_product(list_transform(a, lambda x: CAST(x AS DOUBLE)), list_transform(b, lambda x: CAST(x AS DOUBLE))) / sqrt(list_dot_product(list_transform(a, lambda x: CAST(x AS DOUBLE)), list_transform(a, lambda x: CAST(x AS DOUBLE)))
    * list_dot_product(list_transform(b, lambda x: CAST(x AS DOUBLE)), list_transform(b, lambda x: CAST(x AS DOUBLE)))), 6) AS cosine FROM p WHERE b IS NOT NULL"""
)
def cosine_similarity(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return rows.join(after, "vec_id").select("vec_id", F.round(N.cosine("a", "b"), 6).alias("cosine"))


@query(
    """SELECT p_partkey, round(exp(p_size * ln(20.0) - 20.0 - lgamma(p_size + 1)), 9) AS poisson, round(exp(lgamma(61) - lgamma(p_size + 1) - lgamma(60 - p_size + 1) + p_size * ln(0.4) + (60 - p_size) * ln(0.6)), 9) AS binomial,
    round(-10 * log10((p_size + 1.0) / (p_size + 1000 + 2.0)), 6) AS phred FROM part"""
)
def probabilities(spark, sf_dir):
    n = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.round(N.poisson_pmf("p_size", F.lit(20.0)), 9).alias("poisson"), F.round(N.binomial_pmf(n, F.lit(60), 0.4), 9).alias("binomial"), F.round(N.quality_score(F.lit(1000), n), 6).alias("phred")
    )


# Intervals


@query(
    f"""WITH {I.SPANS_SQL}, e AS (SELECT line, start AS place, 1 AS d FROM spans WHERE start < stop UNION ALL SELECT line, stop, -1 FROM spans WHERE start < stop), g AS (SELECT line, place, sum(d) AS d FROM e GROUP BY 1, 2),
    w AS (SELECT line, place AS start, lead(place) OVER (PARTITION BY line ORDER BY place) AS stop, sum(d) OVER (PARTITION BY line ORDER BY place) AS depth FROM g)
    SELECT line, start, stop, CAST(depth AS BIGINT) AS depth FROM w WHERE stop IS NOT NULL"""
)
def interval_depth(spark, sf_dir):
    return intervals.depth(I.spans(spark, sf_dir), ["line"])


@query(
    f"""WITH {I.SPANS_SQL}, s AS (SELECT *, max(stop) OVER (PARTITION BY line ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM spans WHERE start < stop),
    r AS (SELECT *, sum(CASE WHEN m IS NULL OR start > m THEN 1 ELSE 0 END) OVER (PARTITION BY line ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS run FROM s) SELECT line, min(start) AS start, max(stop) AS stop FROM r GROUP BY line, run"""
)
def merged_intervals(spark, sf_dir):
    return intervals.merged(I.spans(spark, sf_dir), ["line"])


@query(
    f"""WITH {I.SPANS_SQL}, s AS (SELECT *, max(stop) OVER (PARTITION BY line ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM spans WHERE start < stop)
    SELECT line, CAST(sum(greatest(0, stop - greatest(start, coalesce(m, start)))) AS BIGINT) AS covered FROM s GROUP BY 1"""
)
def covered_bases(spark, sf_dir):
    return intervals.covered(I.spans(spark, sf_dir), ["line"])


# Graphs


@query(
    f"""WITH RECURSIVE {I.LINKS_SQL}, sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links), r(node, root) USING KEY (node) AS (SELECT a, least(a, min(b)) FROM sym GROUP BY 1
    UNION SELECT s.b, min(r.root) FROM r JOIN sym s ON s.a = r.node JOIN recurring.r k ON k.node = s.b WHERE r.root < k.root GROUP BY 1) SELECT node, root FROM r"""
)
def connected_components(spark, sf_dir):
    found = graph.components(I.links(spark, sf_dir))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots).distinct()


@query(f"WITH {I.LINKS_SQL} SELECT node, CAST(sum(i) AS BIGINT) AS ins, CAST(sum(o) AS BIGINT) AS outs FROM (SELECT a AS node, 0 AS i, 1 AS o FROM links UNION ALL SELECT b, 1, 0 FROM links) GROUP BY 1")
def degrees(spark, sf_dir):
    return graph.degrees(I.links(spark, sf_dir))


@query(
    """WITH RECURSIVE e AS (SELECT DISTINCT p_partkey % 400 AS a, p_partkey * 7 % 401 AS b FROM part), r AS (SELECT CAST(1 AS BIGINT) AS node, CAST(0 AS BIGINT) AS d UNION SELECT e.b, r.d + 1 FROM r JOIN e ON e.a = r.node WHERE r.d < 12)
    SELECT node, min(d) AS distance FROM r GROUP BY 1"""
)
def graph_distances(spark, sf_dir):
    steps = table(spark, sf_dir, "part").selectExpr("p_partkey % 400 AS a", "p_partkey * 7 % 401 AS b").distinct()
    # of 401 nodes none is farther than 400 steps
    return graph.distances(steps, spark.range(1, 2).select(F.col("id").alias("node")), most=402)


ENDS_SQL = """o AS (SELECT o_custkey * 2 + 1 AS a, o_custkey * 2 + 2 + o_orderkey % 2 AS b, o_totalprice, max(o_totalprice) OVER (PARTITION BY o_custkey) AS best FROM orders),
    l AS (SELECT DISTINCT a, b FROM o WHERE o_totalprice = best), sym AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    one AS (SELECT a, min(b) AS b FROM sym GROUP BY 1 HAVING count(*) = 1)"""


def ends(spark, sf_dir):
    """Each order links a customer's tail to an end of the next customer; the dearest order of the two decides."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey * 2 + 1 AS a", "o_custkey * 2 + 2 + o_orderkey % 2 AS b", "o_totalprice AS jaccard")
    return graph.prune_orientations(rows).select("a", "b")


@query(
    f"""WITH RECURSIVE {ENDS_SQL}, mutual AS (SELECT x.a, x.b FROM one x JOIN one y ON x.a = y.b AND x.b = y.a), free AS (SELECT xor(a, CAST(1 AS BIGINT)) AS x FROM mutual EXCEPT SELECT a FROM mutual),
    w AS (SELECT x AS chain, x AS e, CAST(0 AS BIGINT) AS ordinal FROM free UNION ALL SELECT w.chain, m.b, w.ordinal + 1 FROM w JOIN mutual m ON m.a = xor(w.e, CAST(1 AS BIGINT))),
    f AS (SELECT chain, arg_max(xor(e, CAST(1 AS BIGINT)), ordinal) AS stop FROM w GROUP BY 1)
    SELECT w.chain, ordinal, e // 2 AS scaffold, e % 2 = 1 AS reversed FROM w JOIN f ON w.chain = f.chain WHERE w.chain < f.stop"""
)
def mutual_best_chain(spark, sf_dir):
    return graph.chains(ends(spark, sf_dir))


@query(
    f"""WITH {I.EDGES_SQL}, n AS (SELECT a, max(length) AS longest, count(*) AS n FROM edges GROUP BY 1)
    SELECT edge FROM edges JOIN n USING (a) WHERE b NOT IN (SELECT a FROM edges) AND length <= 200 AND n > 1 AND longest >= 2 * length"""
)
def simple_hangs(spark, sf_dir):
    return graph.simple_hangs(I.edges(spark, sf_dir), 200, 2)


@query(
    f"""WITH {I.PATHS_SQL}, e AS (SELECT unnest(edges[1:len(edges)-1]) % 100 AS a, unnest(edges[2:]) % 2 AS b FROM paths WHERE len(edges) > 1), p AS (SELECT a, b, count(*) AS n FROM e GROUP BY 1, 2),
    s AS (SELECT a, arg_min(b, n * 10 + b) AS edge, min(n) AS n1, max(n) AS n2 FROM p GROUP BY 1 HAVING count(*) = 2) SELECT DISTINCT edge FROM s WHERE n1 <= 100000 AND n2 >= 5 AND n2 >= 1.05 * n1"""
)
def weak_branches(spark, sf_dir):
    pairs = aggregates.bigrams(I.paths(spark, sf_dir)).groupBy((F.col("a") % 100).alias("a"), (F.col("b") % 2).alias("b")).agg(F.sum("n").alias("n"))
    return graph.weak_branches(pairs, 100_000, 5, 1.05)


@query(
    f"""WITH p AS (SELECT l_partkey % 50 AS repeat, l_linenumber % 2 AS a, l_suppkey % 2 AS b, CASE WHEN l_linenumber % 2 = l_suppkey % 2 THEN count(*) ELSE count(*) % 5 END AS n FROM lineitem GROUP BY 1, 2, 3),
    q AS (SELECT repeat, min(n) FILTER (WHERE a = b) AS s, max(n) FILTER (WHERE a <> b) AS x FROM p GROUP BY 1 HAVING count(*) = 4) SELECT repeat, a, b FROM p JOIN q USING (repeat) WHERE a = b AND s >= 5 AND s >= 5 * x AND x <= 4"""
)
def pulled_apart(spark, sf_dir):
    n = F.count("*")
    pairs = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 50).alias("repeat"), (F.col("l_linenumber") % 2).alias("a"), (F.col("l_suppkey") % 2).alias("b")).agg(n.alias("n"))
    return graph.pulled_apart(pairs.withColumn("n", F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(F.col("n") % 5)))


@query()
def unitigs(spark, sf_dir):
    """Unbranched sequences of the items' k-mers; tested on small graphs."""
    rows = kmers.canonical_kmers(I.items(spark, sf_dir).withColumn("seq", S.n_to_a("seq")), 21).select("kmer").distinct()
    return graph.unitigs(rows)


# Streaming extensions, run on the plain table


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, sf_dir):
    return streams.tumbling(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("SELECT CAST(date_trunc('day', ts) - to_days(CAST(o AS INT)) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS o) GROUP BY 1, 2")
def events_sliding(spark, sf_dir):
    return streams.sliding(table(spark, sf_dir, "events"))


@query(
    """WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS n FROM events),
    r AS (SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM s) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 12 HOUR AS stop, count(*) AS n FROM r GROUP BY user_id, s"""
)
def events_sessions(spark, sf_dir):
    return streams.sessions(table(spark, sf_dir, "events"), "12 hours")


# Columns, placements, libraries, alignments


COLUMNS_SQL = "columns_ AS (SELECT l_suppkey % 7 AS rname, l_partkey % 500 AS pos, substr('ACGT', CAST(l_linenumber % 4 + 1 AS INT), 1) AS base, CAST(l_quantity AS INT) AS quality FROM lineitem)"


@query(
    f"""WITH {COLUMNS_SQL}, p AS (SELECT rname, pos, base, count(*) AS n, sum(quality) AS w FROM columns_ GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY rname, pos ORDER BY w DESC, base) AS k,
    sum(n) OVER (PARTITION BY rname, pos) AS depth, sum(w) OVER (PARTITION BY rname, pos) AS total FROM p)
    SELECT rname, pos, CASE WHEN w >= 0.4 * total THEN base ELSE 'N' END AS base, CAST(depth AS BIGINT) AS depth, CAST(w AS BIGINT) AS weight FROM r WHERE k = 1"""
)
def column_consensus(spark, sf_dir):
    base = F.expr("substr('ACGT', l_linenumber % 4 + 1, 1)")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 7).alias("rname"), (F.col("l_partkey") % 500).alias("pos"), base.alias("base"), F.col("l_quantity").cast("int").alias("quality"))
    return alignment.consensus(rows, 0.4)


@query(
    """WITH m AS (SELECT l_suppkey % 9 AS a, l_partkey % 9 AS b, 1 + l_linenumber % 2 AS library, CAST(l_quantity AS BIGINT) AS distance FROM lineitem), l AS (SELECT * FROM (VALUES (1, 500.0, 50.0), (2, 2000.0, 200.0)) AS v(library, separation, sd))
    SELECT a, b, round(sum((separation - distance) / (sd * sd)) / sum(1 / (sd * sd)), 6) AS gap, round(sqrt(1 / sum(1 / (sd * sd))), 6) AS sd, count(*) AS pairs FROM m JOIN l USING (library) GROUP BY 1, 2"""
)
def library_gaps(spark, sf_dir):
    mates = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 9).alias("a"), (F.col("l_partkey") % 9).alias("b"), (1 + F.col("l_linenumber") % 2).alias("library"), F.col("l_quantity").cast("long").alias("distance"))
    known = spark.createDataFrame([(1, 500.0, 50.0), (2, 2000.0, 200.0)], "library int, separation double, sd double")
    return lines_.separations(mates, known).withColumns({"gap": F.round("gap", 6), "sd": F.round("sd", 6)})


@query(
    """WITH r AS (SELECT l_orderkey AS read_id, l_linenumber AS node, l_partkey % 300 AS c, l_orderkey % 2 = 1 AS rev, lead(l_partkey % 300) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS nx FROM lineitem)
    SELECT CASE WHEN rev THEN nx ELSE c END AS a, CASE WHEN rev THEN c ELSE nx END AS b, count(DISTINCT read_id) AS support FROM r WHERE nx IS NOT NULL GROUP BY 1, 2"""
)
def long_read_links(spark, sf_dir):
    # lines of one number are told apart by their part, so that the order is total
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), (F.col("l_linenumber") * 100_000_000 + F.col("l_partkey")).alias("node"), (F.col("l_partkey") % 300).alias("contig_id"), (F.col("l_orderkey") % 2 == 1).alias("reverse"))
    return lines_.read_links(rows)


@query(
    """WITH h AS (SELECT l_orderkey AS read_id, l_suppkey % 20 AS line, l_partkey AS pos, l_linenumber AS kmers, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey % 20, l_partkey) AS r FROM lineitem)
    SELECT read_id, line, pos, kmers, false AS at_home FROM h WHERE r = 1"""
)
def read_placements(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), F.lit(1).alias("barcode"), (F.col("l_suppkey") % 20).alias("line"), F.col("l_partkey").alias("pos"), F.col("l_linenumber").alias("kmers"))
    return lines_.placements(rows)


@query(
    """WITH edges AS (SELECT p_partkey AS edge, p_partkey + 1000000 AS a, p_partkey // 2 AS b, p_size * 10 AS length FROM part), s AS (SELECT CAST(p_partkey AS BIGINT) AS edge, p_size % 5 AS reads, p_partkey * 37 % 100 AS quality FROM part), r AS (SELECT * FROM edges JOIN s USING (edge)),
    o AS (SELECT b, max(quality) AS best FROM r GROUP BY 1 HAVING count(*) = 2) SELECT edge FROM r JOIN o USING (b) WHERE a NOT IN (SELECT b FROM edges) AND length <= 300 AND reads <= 2 AND best >= 1.1 * greatest(1, quality)"""
)
def weak_tips(spark, sf_dir):
    support = table(spark, sf_dir, "part").selectExpr("p_partkey AS edge", "p_size % 5 AS reads", "p_partkey * 37 % 100 AS quality")
    edges = table(spark, sf_dir, "part").selectExpr("p_partkey AS edge", "p_partkey + 1000000 AS a", "p_partkey div 2 AS b", "p_size * 10 AS length")
    return lines_.weak_tips(edges, support, ratio=1.1)


@query("""SELECT p_partkey, 'A' || p_brand || 'C' AS first, length(p_name) AS least FROM part""")
def ambiguous_sequences(spark, sf_dir):
    text = F.concat(F.lit("{A,TT}"), "p_brand", F.lit("{C,}"))
    sizes = ambiguous.lengths(F.concat("p_name", F.lit("{AC,}")))
    return table(spark, sf_dir, "part").select("p_partkey", ambiguous.first_version(text).alias("first"), sizes["least"].cast("long").alias("least"))


@query()
def local_alignments(spark, sf_dir):
    """Neighbouring items aligned locally; tested against a plain table of scores."""
    rows = I.items(spark, sf_dir).select("read_id", F.col("seq").alias("query"))
    after = rows.select((F.col("read_id") - 1).alias("read_id"), F.col("query").alias("target"))
    return alignment.aligned(spread(rows.join(after, "read_id")))


@query()
def graph_lines(spark, sf_dir):
    """Lines of the graph of parts; tested on small graphs."""
    return lines_.lines(I.edges(spark, sf_dir))


# Operators of sets, corrections, finished sequences and clean-up


@query("SELECT o_orderkey, [ascii(c) - 33 FOR c IN string_split(o_orderpriority, '')] AS quals FROM orders")
def phred_scores(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.phred("o_orderpriority").alias("quals"))


@query("SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def union_of_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    return sets.union_all(customers, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")))


@query("SELECT o_custkey, min(o_orderkey) AS partner FROM orders GROUP BY 1")
def unique_with_partner(spark, sf_dir):
    return sets.unique_with_partner(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderkey"))


@query("SELECT o_orderkey, round((o_totalprice / pow(1 + o_custkey % 5, 2) + 1000 / 4.0) / (1 / pow(1 + o_custkey % 5, 2) + 1 / 4.0), 6) AS mean, round(sqrt(1 / (1 / pow(1 + o_custkey % 5, 2) + 1 / 4.0)), 9) AS sd FROM orders")
def combined_normals(spark, sf_dir):
    both = N.combine_normals(F.col("o_totalprice").cast("double"), 1.0 + F.col("o_custkey") % 5, F.lit(1000.0), F.lit(2.0))
    return table(spark, sf_dir, "orders").select("o_orderkey", both.alias("n")).select("o_orderkey", F.round("n.mean", 6).alias("mean"), F.round("n.sd", 9).alias("sd"))


@query(
    f"""WITH {I.ITEMS_SQL}, starts AS (SELECT read_id, translate(seq, 'N', 'A') AS seq, unnest(range(1, length(seq) - 7)) AS i FROM items WHERE length(seq) >= 9), k AS (SELECT read_id, i - 1 AS pos, substr(seq, i, 9) AS kmer FROM starts),
    c AS (SELECT least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS c, count(*) AS n FROM k GROUP BY 1),
    weak AS (SELECT k.* FROM k JOIN c ON c.c = least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) WHERE n <= 1),
    tried AS (SELECT *, substr(kmer, 1, 4) || x || substr(kmer, 6) AS changed FROM weak, (SELECT unnest(['A', 'C', 'G', 'T']) AS x) WHERE x <> substr(kmer, 5, 1))
    SELECT read_id, pos + 4 AS pos, substr(kmer, 5, 1) AS base, min(x) AS correct FROM tried JOIN c ON c.c = least(changed, reverse(translate(changed, 'ACGT', 'TGCA'))) WHERE n >= 3 GROUP BY read_id, pos, kmer HAVING count(*) = 1"""
)
def error_candidates(spark, sf_dir):
    """Uncalled bases are taken as A, as ingest does."""
    return alignment.error_candidates(I.items(spark, sf_dir).withColumn("seq", S.n_to_a("seq")), 9)


@query(
    """WITH b AS (SELECT o_custkey % 5 AS rname, o_orderkey AS pos, o_totalprice >= 40000 AS same FROM orders), r AS (SELECT *, count(*) FILTER (WHERE NOT same) OVER (PARTITION BY rname ORDER BY pos) AS run FROM b),
    h AS (SELECT v, count(*) AS c FROM (SELECT count(*) AS v FROM r WHERE same GROUP BY rname, run) GROUP BY 1),
    w AS (SELECT v, sum(v * c) OVER (ORDER BY v) AS upto, lead(v) OVER (ORDER BY v) AS nx, sum(v * c) OVER () AS total FROM h)
    SELECT (SELECT CAST(arg_min(CASE WHEN 2 * upto = total AND nx IS NOT NULL THEN (v + nx) // 2 ELSE v END, v) AS BIGINT) FROM w WHERE 2 * upto >= total) AS perfect_n50,
    (SELECT round(1000 * count(*) FILTER (WHERE NOT same) / count(*), 9) FROM b) AS errors_per_kb"""
)
def perfect_stretches(spark, sf_dir):
    """Orders as a finished sequence; cheap ones differ from it or, below 10 000, are lacking."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("rname"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("base"), "o_totalprice")
    seen = rows.where("o_totalprice >= 10000").withColumn("base", F.when(F.col("o_totalprice") < 40_000, "N").otherwise(F.col("base")))
    return alignment.perfect_stretches(seen.drop("o_totalprice"), rows.drop("o_totalprice")).withColumn("errors_per_kb", F.round("errors_per_kb", 9))


JUMPS_SQL = """jumps AS (SELECT l_orderkey AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS qs, CAST(round(l_extendedprice * 100) AS BIGINT) + 1 + l_partkey AS qe, l_suppkey % 2 AS t,
    CASE WHEN l_quantity > 15 THEN '+' ELSE '-' END AS strand, l_partkey * 1000 AS ts, l_partkey * 1000 + 500 AS te FROM lineitem)"""


@query(
    f"""WITH {JUMPS_SQL}, p AS (SELECT *, lag(t) OVER o AS t0, lag(strand) OVER o AS strand0, lag(ts) OVER o AS ts0, lag(te) OVER o AS te0, lag(qe) OVER o AS qe0, row_number() OVER o AS r FROM jumps WINDOW o AS (PARTITION BY q ORDER BY qs, qe))
    SELECT q, count(*) FILTER (WHERE NOT (t = t0 AND strand = strand0 AND abs(CASE strand WHEN '+' THEN ts - te0 ELSE ts0 - te END - (qs - qe0)) <= 5000000)) AS breaks FROM p WHERE r > 1 GROUP BY 1"""
)
def misjoins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS q", "cast(round(l_extendedprice * 100) AS bigint) AS qs", "cast(round(l_extendedprice * 100) AS bigint) + 1 + l_partkey AS qe", "l_suppkey % 2 AS t",
        "if(l_quantity > 15, '+', '-') AS strand", "l_partkey * 1000 AS ts", "l_partkey * 1000 + 500 AS te",
    )
    return alignment.misjoins(rows, 5_000_000)


@query(
    """WITH p AS (SELECT l_partkey % 50 AS edge, lead(l_partkey % 50) OVER o AS next, lead(l_partkey % 50, 2) OVER o AS after, l_suppkey % 50 AS rc FROM lineitem WINDOW o AS (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey))
    SELECT DISTINCT next AS edge FROM p WHERE after = rc"""
)
def inversion_bubbles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS line", "struct(l_extendedprice, l_orderkey, l_linenumber, l_partkey) AS ordinal", "l_partkey % 50 AS edge", "l_suppkey % 50 AS rc")
    return graph.inversion_bubbles(rows)


ENDS_OF_LINES_SQL = """ends AS (SELECT l_orderkey * 4 + (l_linenumber - 1) // 2 AS pair_id, (l_linenumber - 1) % 2 AS mate, l_suppkey % 40 * 2 + l_partkey % 2 AS line,
    xor(l_suppkey % 40 * 2 + l_partkey % 2, 1) AS rc_line, l_partkey % 900 AS distance, l_orderkey % 97 AS support_id FROM lineitem)"""


@query(
    f"""WITH {ENDS_OF_LINES_SQL} SELECT x.line AS a, y.rc_line AS b, count(DISTINCT x.support_id) AS support FROM ends x JOIN ends y USING (pair_id) WHERE x.mate = 0 AND y.mate = 1 AND x.distance + y.distance <= 1000
    AND x.line <> y.line AND x.line <> y.rc_line GROUP BY 1, 2 HAVING count(DISTINCT x.support_id) >= 2"""
)
def pair_links(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 4 + (l_linenumber - 1) div 2 AS pair_id", "(l_linenumber - 1) % 2 AS mate", "l_suppkey % 40 * 2 + l_partkey % 2 AS line", "(l_suppkey % 40 * 2 + l_partkey % 2) ^ 1 AS rc_line",
        "l_partkey % 900 AS distance", "l_orderkey % 97 AS support_id",
    )
    return graph.pair_links(rows)


@query(f"WITH chained AS ({ORACLE_SQL['mutual_best_chain']}) SELECT * FROM chained UNION ALL SELECT 2 * c_custkey, 0, c_custkey, false FROM customer WHERE c_custkey NOT IN (SELECT scaffold FROM chained)")
def chains_and_singletons(spark, sf_dir):
    return graph.with_singletons(mutual_best_chain(spark, sf_dir), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scaffold")))


@query(
    """WITH e AS (SELECT p_partkey AS edge, p_partkey // 4 AS g, CAST(p_size AS BIGINT) AS length, p_partkey % 3 AS multiplicity FROM part),
    per AS (SELECT g FROM e GROUP BY 1 HAVING coalesce(sum(length) FILTER (WHERE multiplicity = 1), 0) < 0.3 * sum(length)) SELECT edge FROM e JOIN per USING (g)"""
)
def low_unique(spark, sf_dir):
    """Four parts in a row make a component: edges from one node to four others."""
    parts = table(spark, sf_dir, "part")
    rows = parts.selectExpr("p_partkey AS edge", "p_partkey div 4 * 8 AS a", "p_partkey div 4 * 8 + 1 + p_partkey % 4 AS b", "cast(p_size AS bigint) AS length")
    return graph.low_unique(rows, parts.selectExpr("p_partkey AS edge", "p_partkey % 3 AS multiplicity"), fraction=0.3)


@query(
    """WITH e AS (SELECT p_partkey AS edge, p_partkey // 2 AS g, p_size AS length FROM part), two AS (SELECT g FROM e GROUP BY 1 HAVING count(*) = 2), own AS (SELECT DISTINCT l_partkey AS edge, l_orderkey AS pair_id FROM lineitem),
    t AS (SELECT x.edge AS edge, y.edge AS other FROM e x JOIN e y USING (g) JOIN two USING (g) WHERE x.edge <> y.edge AND abs(x.length - y.length) BETWEEN 1 AND 20),
    n AS (SELECT edge, other, (SELECT count(*) FROM own WHERE own.edge = t.edge) AS n1, (SELECT count(*) FROM own WHERE own.edge = t.other) AS n2,
    (SELECT count(*) FROM own p JOIN own q USING (pair_id) WHERE p.edge = t.edge AND q.edge = t.other) AS c FROM t) SELECT edge FROM n WHERE n1 - c <= 30 AND n2 - c >= 1.5 * greatest(1, n1 - c)"""
)
def weak_bubbles(spark, sf_dir):
    """Two parts in a row are the branches of a bubble, the orders that hold them its pairs."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS edge", "p_partkey div 2 * 2 AS a", "p_partkey div 2 * 2 + 1 AS b", "p_size AS length")
    return graph.weak_bubbles(rows, table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS edge", "l_orderkey AS pair_id"), 20, 30, 1.5)
