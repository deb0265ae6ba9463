"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, in order of code points with null last, weigh 5, 2, 1 and so on again; a source's share of all words is
its target, but at most ``CEILING`` times its own words: the excess goes to the others by weight until none is
above. A source's words are taken in complete epochs first. For the rest each document draws an exponential key,
divided by its quality weight; in the order of the keys, documents are taken while their prefix sum stays
within the budget. Then up to ``TRIED`` documents are tried, in the order of the keys: one is taken if it still
fits, and in the end the first whose excess over the budget is less than what would be missing.

No source is sorted in one task: a histogram of the keys' logarithms, ``BINS`` to a power of two, tells in which
bin the prefix sum passes the budget. Only that bin and those that the tried documents lie in are sorted; a bin holds a
few in ten thousand of a source's keys, whatever the weights. Keys come from hashes of the id and the text, so that
reruns and retried tasks agree.

quality weight: the share of the text's characters that are not of ``#*$%&|<>`` nor digits, squared, at least 0.05.

Defined cases: a null text has size 0 and takes nothing. A null source is a source, the last one. Documents of
equal keys and hashes (repeated rows) are taken or left together, and tried as one. A very long text that doesn't fit is
passed over. If all texts are empty, targets are 0. An empty table gives an empty result. Other columns are ignored by
``mix`` and kept by ``apply``, whatever their names. The sources' targets are found in one task, of a row a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.runtime import materialize

from .common import columns_of, rows_of, with_row

WEIGHTS = (5, 2, 1)
CEILING = 3
BINS = 1024
#: Documents tried, in the order of keys, to fill up what the prefix leaves of a budget.
TRIED = 64
#: The bin of keys of zero.
LOWEST = -(1 << 30)
NOISE = "#*$%&|<>0123456789"


def size_of(text: Column) -> Column:
    """Words (runs of anything but 0x20 and 0x09-0x0D)."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(text.isNull() | (bare == ""), 0).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def quality_of(text: Column) -> Column:
    share = F.length(F.translate(text, NOISE, "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), share * share)


def keyed(docs: DataFrame) -> DataFrame:
    """docs and: _size, _key (exponential, divided by the quality weight), _tie."""
    uniform = (F.pmod(F.xxhash64(F.lit("key"), "doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    text = F.col("text").cast("string")
    return docs.withColumns(
        {
            "_size": size_of(text),
            "_key": F.coalesce(-F.log(uniform) / quality_of(text), F.lit(0.0)),
            "_tie": F.xxhash64(F.lit("tie"), "doc_id", "text"),
        }
    )


def binned(key: Column) -> Column:
    """The bin of a key; bins are in the order of keys."""
    return F.coalesce(F.floor(F.log2(key) * BINS), F.lit(LOWEST)).cast("int")


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size and, beside them, target. One row a source; both windows sort and stream them.

    Resharing until none is above its ceiling ends where the sources of least ceiling for their weight are at the
    ceiling and the others share what is left by weight: the first k in that order, for the least k that works.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(place, F.lit(len(WEIGHTS))) + 1).cast("int"))
    everything = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    totals = F.sum("source_size").over(Window.partitionBy(F.lit(0))), F.sum("weight").over(Window.partitionBy(F.lit(0)))
    level = sources.withColumn("weight", weight).withColumn("ceiling", (CEILING * F.col("source_size")).cast("double")).withColumn("ratio", F.col("ceiling") / F.col("weight"))
    level = level.withColumns({"total": totals[0].cast("double"), "weights": totals[1]}).withColumns(
        {"spent": F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)), "gone": F.coalesce(F.sum("weight").over(before), F.lit(0.0))}
    )
    # the level is what a unit of weight gets once the sources before this one are at their ceilings
    level = level.withColumn("unit", (F.col("total") - F.col("spent")) / (F.col("weights") - F.col("gone")))
    # units fall from the first source that stays below its ceiling on
    settled = F.max(F.when(F.col("ratio") >= F.col("unit"), F.col("unit"))).over(Window.partitionBy(F.lit(0)))
    return level.withColumn("settled", settled).select(
        "source", "source_size", F.when(F.col("ratio") >= F.col("unit"), F.col("weight") * F.col("settled")).otherwise(F.col("ceiling")).alias("target")
    )


#: Up to this many sources, what is decided for each is broadcast; beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 50_000


def by_source(rows: DataFrame, table: DataFrame, sources: int) -> DataFrame:
    """Inner join on source, null with null. table has one row a source, its source column named _source."""
    return rows.join(F.broadcast(table) if sources <= BROADCAST_SOURCES else table, rows["source"].eqNullSafe(table["_source"])).drop("_source")


def decisions(narrow: DataFrame) -> tuple[DataFrame, int]:
    """What is decided for each source, and the number of sources. narrow: source, _size, _key, _tie of all documents.

    _source, source_size, target, epochs; the documents of the fraction are those of the bins below _bin, those
    from it up to (_last_key, _last_tie), and those of _more.
    """
    sources = narrow.groupBy("source").agg(F.sum("_size").alias("source_size"))
    aims = targets(sources).withColumn("epochs", F.least(F.lit(CEILING), F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))).cast("long"))
    aims = materialize(aims.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))), "aims")
    count = aims.count()
    rows = narrow.where("_size > 0").withColumn("_at", binned(F.col("_key")))
    bins = rows.groupBy("source", "_at").agg(F.sum("_size").alias("words"), F.count("*").alias("docs"))
    order = Window.partitionBy("source").orderBy("_at")
    bins = bins.withColumns({"upto": F.sum("words").over(order), "docs_upto": F.sum("docs").over(order)})
    budgets = aims.select(F.col("source").alias("_source"), "budget")
    # from the bin where the sum passes the budget to the one by which as many more documents follow as are tried
    beyond = by_source(bins, budgets, count).where("upto > budget").withColumn("edge", F.min(F.struct("_at", "upto", "words", "docs_upto")).over(Window.partitionBy("source")))
    edge = (
        beyond.where((F.col("_at") == F.col("edge._at")) | (F.col("docs_upto") - F.col("docs") < F.col("edge.docs_upto") + TRIED))
        .groupBy("source")
        .agg(F.max("_at").alias("_to"), F.first("edge").alias("edge"), F.first("budget").alias("budget"))
        .select(F.col("source").alias("_source"), F.col("edge._at").alias("_bin"), "_to", (F.col("budget") - F.col("edge.upto") + F.col("edge.words")).alias("room"))
    )
    edge = materialize(edge, "edges")
    # equal keys, as repeated rows have them, are one row from here on
    near = by_source(rows, edge, count).where("_at >= _bin AND _at <= _to").groupBy("source", "_key", "_tie", "room").agg(F.sum("_size").alias("words"))
    keys = Window.partitionBy("source").orderBy("_key", "_tie")
    near = materialize(near.withColumn("upto", F.sum("words").over(keys)), "near")
    last = near.where("upto <= room").groupBy("source").agg(F.max(F.struct("_key", "_tie")).alias("k"), F.max("upto").alias("upto"))
    tried = near.where("upto > room").withColumn("n", F.row_number().over(keys)).where(F.col("n") <= TRIED)
    tried = tried.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("_key", "_tie", "words"))).alias("tried"), F.first("room").alias("room"))
    filled = last.select(F.col("source").alias("_l"), "k", "upto").join(tried, F.col("_l").eqNullSafe(F.col("source")), "full_outer")
    filled = filled.select(F.coalesce("source", "_l").alias("_f"), "k", "tried", (F.col("room") - F.coalesce("upto", F.lit(0))).alias("gap"))
    none = "cast(array() as array<struct<_key: double, _tie: bigint, words: bigint>>)"
    filled = filled.withColumn("fit", F.expr(f"aggregate(coalesce(tried, {none}), struct(cast(gap as double) as gap, {none} as more), (s, x) -> if(x.words <= s.gap, struct(s.gap - x.words as gap, concat(s.more, array(x)) as more), s))"))
    # what still fits is taken, so any other of the tried exceeds the gap
    over = F.expr("filter(tried, x -> x.words < 2 * fit.gap and not array_contains(fit.more, x))")
    filled = filled.select("_f", F.col("k._key").alias("_last_key"), F.col("k._tie").alias("_last_tie"), F.concat("fit.more", F.coalesce(F.slice(over, 1, 1), F.expr(none))).alias("_more"))
    settled = (
        aims.select(F.col("source").alias("_source"), "source_size", "target", "epochs")
        .join(edge.select(F.col("_source").alias("_e"), "_bin"), F.col("_source").eqNullSafe(F.col("_e")), "left")
        .join(filled, F.col("_source").eqNullSafe(F.col("_f")), "left")
        .select("_source", "source_size", "target", "epochs", "_bin", "_last_key", "_last_tie", "_more")
    )
    return materialize(settled, "mix"), count


def of_prefix() -> Column:
    """Whether a document's key is among those taken in order."""
    upto = (F.col("_key") < F.col("_last_key")) | ((F.col("_key") == F.col("_last_key")) & (F.col("_tie") <= F.col("_last_tie")))
    return F.coalesce((F.col("_at") < F.col("_bin")) | upto, F.lit(False))


def tried_and_taken() -> Column:
    """Whether a document is one of those taken to fill the budget up."""
    return F.coalesce(F.exists("_more", lambda t: (t["_key"] == F.col("_key")) & (t["_tie"] == F.col("_tie"))), F.lit(False))


def times() -> Column:
    """How often a document is taken, given its key and its source's decisions."""
    return F.col("epochs") + F.when((F.col("_size") > 0) & (of_prefix() | tried_and_taken()), 1).otherwise(0)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every document."""
    narrow = materialize(keyed(columns_of(docs, doc_id="long", source="string", text="string")).select("doc_id", "source", "_size", "_key", "_tie"), "keys")
    settled, count = decisions(narrow)
    rows = by_source(narrow.withColumn("_at", binned(F.col("_key"))), settled, count)
    return rows.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * times()).alias("taken"))


def apply(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with all its columns."""
    narrow = materialize(keyed(columns_of(docs, doc_id="long", source="string", text="string")).select("source", "_size", "_key", "_tie"), "keys")
    settled, count = decisions(narrow)
    named = with_row(docs, doc_id="long", source="string", text="string")
    rows = by_source(keyed(named).withColumn("_at", binned(F.col("_key"))), settled, count)
    return rows_of(rows.select("_row", F.explode(F.array_repeat(F.lit(0), times().cast("int")))), docs)
