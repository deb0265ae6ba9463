"""The driver's tables, seen as reads, alignments, paths and scaffolds. Each view has its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.runtime import spread, table

ALPHABET, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"

READS_SQL = f"""reads AS (SELECT doc_id AS read_id, CAST(substr(source, 4) AS BIGINT) AS barcode,
  regexp_replace(translate(lower(text), '{ALPHABET}', '{BASES}'), '[^ACGT]', 'N', 'g') AS seq FROM documents)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, barcode, seq: letters of documents as bases, anything else as N."""
    seq = F.regexp_replace(F.translate(F.lower("text"), ALPHABET, BASES), "[^ACGT]", "N")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(F.col("doc_id").alias("read_id"), F.expr("cast(substr(source, 4) as bigint)").alias("barcode"), seq.alias("seq"))


ITEMS_SQL = f"""items AS (SELECT item_id AS read_id, item_id % 7 AS barcode,
  regexp_replace(translate(lower(text), '{ALPHABET}', '{BASES}'), '[^ACGT]', 'N', 'g') AS seq FROM benchmark)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, barcode, seq of the benchmark's texts."""
    seq = F.regexp_replace(F.translate(F.lower("text"), ALPHABET, BASES), "[^ACGT]", "N")
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("read_id"), (F.col("item_id") % 7).alias("barcode"), seq.alias("seq"))


CYCLES_SQL = "cycles AS (SELECT CAST(l_orderkey % 2 AS INT) AS mate, l_linenumber - 1 AS pos, CAST(l_quantity AS INT) AS q FROM lineitem)"


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mate, pos, q: order lines as the cycles of reads, quantities as qualities."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 2).cast("int").alias("mate"), (F.col("l_linenumber") - 1).alias("pos"), F.col("l_quantity").cast("int").alias("q"))


READS_OF_ORDERS_SQL = """pairs AS (SELECT o_orderkey AS pair_id, o_custkey % 97 AS barcode, substr(o_orderpriority, 3) AS seq1, o_orderstatus AS seq2,
  [CAST(floor(o_totalprice) AS INT) % 40] AS quals1, [CAST(o_custkey % 30 AS INT)] AS quals2 FROM orders)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, barcode, seq1, seq2, quals1, quals2 from orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pair_id"), (F.col("o_custkey") % 97).alias("barcode"), F.expr("substr(o_orderpriority, 3)").alias("seq1"), F.col("o_orderstatus").alias("seq2"),
        F.array(F.floor("o_totalprice").cast("int") % 40).alias("quals1"), F.array((F.col("o_custkey") % 30).cast("int")).alias("quals2"),
    )


ALIGNMENTS_SQL = """alignments AS (SELECT l_orderkey * 8 + l_linenumber AS qname, l_suppkey % 11 AS barcode, l_returnflag = 'R' AS is_read1, l_linestatus = 'O' AS is_reverse,
  CAST(l_linenumber AS BIGINT) AS tid, l_partkey % 40 AS pos, l_suppkey % 5 AS mate_tid, l_partkey % 3 AS mate_pos, l_discount > 0.04 AS perfect,
  'f' AS flowcell, CAST(l_linenumber % 2 AS INT) AS lane, CAST(floor(l_extendedprice) AS BIGINT) % 30000 AS x, CAST(l_quantity AS BIGINT) AS y, l_tax < 0.07 AS mapped FROM lineitem)"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment rows from order lines."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS qname", "l_suppkey % 11 AS barcode", "l_returnflag = 'R' AS is_read1", "l_linestatus = 'O' AS is_reverse", "cast(l_linenumber AS bigint) AS tid",
        "l_partkey % 40 AS pos", "l_suppkey % 5 AS mate_tid", "l_partkey % 3 AS mate_pos", "l_discount > 0.04 AS perfect", "'f' AS flowcell", "cast(l_linenumber % 2 AS int) AS lane",
        "cast(floor(l_extendedprice) AS bigint) % 30000 AS x", "cast(l_quantity AS bigint) AS y", "l_tax < 0.07 AS mapped",
    )


POINTS_SQL = "points AS (SELECT user_id % 5 AS line, user_id AS barcode, CAST(floor(epoch(ts)) AS BIGINT) - 1600000000 AS pos, event_id AS pair_id FROM events)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, barcode, pos, pair_id: events as reads on lines, their time as position."""
    return table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("line"), F.col("user_id").alias("barcode"), (F.unix_timestamp("ts") - 1_600_000_000).alias("pos"), F.col("event_id").alias("pair_id"))


SPANS_SQL = "spans AS (SELECT l_suppkey % 20 AS line, l_partkey % 5000 * 20 AS start, l_partkey % 5000 * 20 + CAST(l_quantity AS BIGINT) * 100 AS stop FROM lineitem)"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, start, stop: intervals from order lines."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey % 20 AS line", "l_partkey % 5000 * 20 AS start", "l_partkey % 5000 * 20 + cast(l_quantity AS bigint) * 100 AS stop")


PATHS_SQL = "paths AS (SELECT l_orderkey AS read_id, list(l_partkey % 200 ORDER BY l_linenumber, l_partkey) AS edges FROM lineitem GROUP BY l_orderkey)"


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, edges: the parts of an order as the edges of a read's path."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey").alias("k"))
    return lines.groupBy(F.col("l_orderkey").alias("read_id")).agg(F.transform(F.array_sort(F.collect_list("k")), lambda k: k["l_partkey"] % 200).alias("edges"))


PLACEMENTS_SQL = """placements AS (SELECT l_orderkey * 4 + (l_linenumber - 1) // 2 AS pair_id, (l_linenumber - 1) % 2 AS mate, l_suppkey % 3 AS edge, l_suppkey % 3 + 100 AS rc_edge, l_partkey % 2000 AS start, l_partkey % 2000 + 150 AS stop,
  CAST(2500 AS BIGINT) AS edge_length, l_orderkey % 13 AS barcode FROM lineitem)"""


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, mate, edge, rc_edge, start, stop, edge_length, barcode: the lines of an order, two by two, as placed mates."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 4 + (l_linenumber - 1) div 2 AS pair_id", "(l_linenumber - 1) % 2 AS mate", "l_suppkey % 3 AS edge", "l_suppkey % 3 + 100 AS rc_edge", "l_partkey % 2000 AS start", "l_partkey % 2000 + 150 AS stop",
        "cast(2500 AS bigint) AS edge_length", "l_orderkey % 13 AS barcode",
    )


LINKS_SQL = "links AS (SELECT DISTINCT 2 * l_partkey AS a, 2 * l_orderkey + 1 AS b FROM lineitem)"


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a, b: parts and the orders that hold them as a graph."""
    return table(spark, sf_dir, "lineitem").selectExpr("2 * l_partkey AS a", "2 * l_orderkey + 1 AS b").distinct()


EDGES_SQL = """edges AS (SELECT CAST(p_partkey AS BIGINT) AS edge, p_partkey % 300 AS a, p_partkey * 7 % 311 + 300 AS b, CAST(p_size AS BIGINT) * 10 AS length, CAST(p_partkey AS BIGINT) + 1000000 AS rc FROM part)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edge, a, b, length, rc: parts as the edges of a graph."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS edge", "p_partkey % 300 AS a", "p_partkey * 7 % 311 + 300 AS b", "cast(p_size AS bigint) * 10 AS length", "p_partkey + 1000000 AS rc")
