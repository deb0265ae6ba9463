"""Writers of sequences, histograms and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions import sequence as S


def fasta_text(records: DataFrame, width: int = 80, least: int = 1000, name: str = "name", seq: str = "seq") -> DataFrame:
    """value: FASTA records of sequences of at least so many bases, wrapped."""
    return records.where(F.length(seq) >= least).select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), S.wrap(seq, width)).alias("value"))


def fastq_text(records: DataFrame, name: str = "name", seq: str = "seq", qual: str = "qual") -> DataFrame:
    return records.select(F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual)).alias("value"))


def scaffold_text(parts: DataFrame, width: int = 80) -> DataFrame:
    """value: a FASTA record for each chain. parts: chain, ordinal, name, seq, reversed, gap (N before the part).

    The header names the parts and gaps: ``chain name + gap N + name``. A gap of -1 isn't known and is an error.
    """
    checked = parts.where(F.assert_true((F.col("ordinal") == 0) | (F.col("gap") >= 0), F.lit("a gap without a size")).isNull())
    strand = F.when(F.col("reversed"), S.reverse_complement("seq")).otherwise(F.col("seq"))
    gap = F.when(F.col("ordinal") > 0, F.col("gap")).otherwise(0).cast("int")
    rows = checked.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.concat(F.repeat(F.lit("N"), gap), strand).alias("seq"), "name", gap.alias("gap")))).alias("p"))
    label = F.concat_ws(" + ", F.flatten(F.transform("p", lambda x: F.when(x["ordinal"] > 0, F.array(F.concat(x["gap"].cast("string"), F.lit(" N")), x["name"])).otherwise(F.array(x["name"])))))
    seq = F.concat_ws("", F.transform("p", lambda x: x["seq"]))
    return rows.select("chain", F.concat(F.lit(">"), F.col("chain").cast("string"), F.lit(" "), label, F.lit("\n"), S.wrap(seq, width)).alias("value"))


def haplotype_sequences(shared: DataFrame, alleles: DataFrame) -> DataFrame:
    """name, allele, seq: an allele's own version of a scaffold where there is one, else the shared one.

    shared: name, seq. alleles: name, allele, seq.
    """
    kinds = [r.allele for r in alleles.select("allele").distinct().orderBy("allele").limit(1000).collect()]
    own = alleles.select("name", "allele", F.col("seq").alias("_own"))
    return shared.withColumn("allele", F.explode(F.lit(kinds))).join(own, ["name", "allele"], "left").select("name", "allele", F.coalesce("_own", "seq").alias("seq"))


def line_flavours(cells: DataFrame, flavour: str) -> DataFrame:
    """Sequences of lines whose cells have branches: raw, megabubbles, pseudohap or pseudohap2.

    cells: line, cell, branch (from 0), support, seq. raw: every branch apart; megabubbles: alike for cells with
    several branches, runs of single ones joined; pseudohap: the branch of most support; pseudohap2: two versions,
    of the best and the second branch.
    """
    best = Window.partitionBy("line", "cell").orderBy(F.desc("support"), "branch")
    ranked = cells.withColumns({"rank": F.row_number().over(best), "n": F.count("*").over(Window.partitionBy("line", "cell"))})
    joined = lambda df, *by: df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cell", "seq"))).alias("p")).select(*by, F.concat_ws("", F.transform("p", lambda x: x["seq"])).alias("seq"))
    label = lambda *c: F.concat_ws("_", *[F.col(x).cast("string") for x in c])
    if flavour == "raw":
        return ranked.select(label("line", "cell", "branch").alias("name"), "seq")
    if flavour == "pseudohap":
        return joined(ranked.where("rank = 1"), "line").select(label("line").alias("name"), "seq")
    if flavour == "pseudohap2":
        two = ranked.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).where("rank = least(version, n)")
        return joined(two, "line", "version").select(label("line", "version").alias("name"), "seq")
    if flavour == "megabubbles":
        order = Window.partitionBy("line").orderBy("cell")
        plain = ranked.where("n = 1").withColumn("run", F.col("cell") - F.row_number().over(order))
        runs = joined(plain, "line", "run").select(F.concat_ws("_", F.col("line").cast("string"), F.lit("run"), F.col("run").cast("string")).alias("name"), "seq")
        return runs.unionByName(ranked.where("n > 1").select(label("line", "cell", "branch").alias("name"), "seq"))
    raise ValueError(f"no flavour {flavour}")


def histogram_json(bins: DataFrame, description: str, stage: str, binsize: float) -> DataFrame:
    """value: one JSON object of a histogram with rows bin, n. Bins without a value are 0."""
    low, high = bins.agg(F.min("bin"), F.max("bin")).first()
    count = 0 if low is None else int(round((high - low) / binsize)) + 1
    at = bins.select(F.round((F.col("bin") - F.lit(low)) / binsize).cast("int").alias("i"), "n")
    cells = F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("m")
    vals = F.transform(F.sequence(F.lit(0), F.lit(max(0, count - 1))), lambda i: F.coalesce(F.col("m")[i], F.lit(0)))
    fields = {"description": F.lit(description), "stage": F.lit(stage), "binsize": F.lit(binsize), "min": F.lit(low), "max": F.lit(high), "numbins": F.lit(count), "vals": vals if count else F.array().cast("array<long>")}
    return at.agg(cells).select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("value"))


def metrics_text(metrics: DataFrame) -> DataFrame:
    """value: ``name value``, one line a metric. metrics: name, type, value, gloss, cs."""
    return metrics.select(F.concat_ws(" ", "name", "value").alias("value"))


def metrics_csv(metrics: DataFrame) -> DataFrame:
    """One row with a column for each metric meant for customers; write it with a header."""
    shown = metrics.where("cs").select("name", "value")
    names = [r.name for r in shown.select("name").distinct().orderBy("name").limit(10_000).collect()]
    return shown.groupBy().pivot("name", names).agg(F.first("value"))


def metrics_json(metrics: DataFrame, described: bool = False) -> DataFrame:
    """value: one JSON object of all metrics, numbers as numbers, with their glosses if asked for."""
    number = F.col("value").try_cast("double")
    shown = F.when(F.col("type") == "INT", F.col("value").try_cast("long").cast("string")).when(F.col("type") == "DOUBLE", number.cast("string")).otherwise(F.to_json(F.array("value")).substr(F.lit(2), F.length(F.to_json(F.array("value"))) - 2))
    item = F.concat(F.lit('"'), F.col("name"), F.lit('": '), F.concat(F.lit('{"value": '), shown, F.lit(', "description": "'), F.col("gloss"), F.lit('"}')) if described else shown)
    return metrics.agg(F.concat(F.lit("{"), F.concat_ws(", ", F.array_sort(F.collect_list(item))), F.lit("}")).alias("value"))


def write_text(values: DataFrame, path: str, compressed: bool = True) -> None:
    """Write a value column as text; records keep their own line breaks."""
    values.select("value").write.mode("errorifexists").option("compression", "gzip" if compressed else "none").text(path)


def vcf_text(variants: DataFrame) -> DataFrame:
    """value: VCF lines of variants with the columns of ``text.vcf``, without their header."""
    or_dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    info = F.when(F.size("info") > 0, F.concat_ws(";", F.array_sort(F.transform(F.map_entries("info"), lambda e: F.when(e["value"].isNull(), e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"])))))).otherwise(".")
    return variants.select(F.concat_ws("\t", F.col("chrom"), (F.col("pos") + 1).cast("string"), or_dot("id"), "ref", F.concat_ws(",", "alt"), or_dot("qual"), or_dot("filter"), info).alias("value"))
