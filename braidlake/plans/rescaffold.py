"""Re-scaffolding: sequences are joined whose ends share barcodes, with gaps sized from barcode bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.operators import graph, joins, sets, windows
from braidlake.runtime import materialize
from braidlake.sources import sinks


def numbered(scaffolds: DataFrame) -> DataFrame:
    """Scaffolds (name, seq) with scaffold_id and length. Numbers follow the order of names; there are few scaffolds
    beside reads, and only names are sorted."""
    from pyspark.sql import Window

    ids = scaffolds.select("name").withColumn("scaffold_id", (F.row_number().over(Window.orderBy("name")) - 1).cast("long"))
    return scaffolds.join(ids, "name").withColumn("length", F.length("seq"))


def end_windows(points: DataFrame, scaffolds: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Reads of each barcode in the first and the second window of both ends of scaffolds that are long enough.

    points: scaffold_id, pos, barcode. An end is 2 * scaffold_id for the head, that and 1 for the tail.
    """
    # long enough with all bases, and with those called
    long = scaffolds.where((F.col("length") >= 2 * window) & (F.length(F.regexp_replace("seq", "[Nn]", "")) >= 2 * window)).select("scaffold_id", "length")
    rows = points.join(long, "scaffold_id")
    head = rows.select((2 * F.col("scaffold_id")).alias("end"), "barcode", F.col("pos").alias("off"))
    tail = rows.select((2 * F.col("scaffold_id") + 1).alias("end"), "barcode", (F.col("length") - F.col("pos") - 1).alias("off"))
    both = head.unionByName(tail).where(F.col("off").between(0, 2 * window - 1)).withColumn("near", F.col("off") < window)
    per = materialize(both.groupBy("near", "end", "barcode").agg(F.count("*").alias("reads")), "ends")
    return per.where("near").drop("near"), per.where("not near").drop("near")


def run(scaffolds: DataFrame, points: DataFrame, paf: DataFrame | None = None, molecule: int | None = None, least_gap: int = 10, most_gap: int = 100_000, width: int = 80) -> dict[str, DataFrame]:
    """All steps. scaffolds: name, seq. points: scaffold (name), pos, barcode. paf: alignments among scaffolds.

    Gives 'chains' (chain, ordinal, scaffold, reversed, name, gap), 'links' and 'text' (FASTA records). The window
    is a quarter of the molecule length, or 20 000.
    """
    window = molecule // 4 if molecule else 20_000
    whole = materialize(numbered(scaffolds), "scaffolds")
    named = whole.select("scaffold_id", "name", "length")
    placed = materialize(points.join(named.withColumnRenamed("name", "scaffold"), "scaffold").select("scaffold_id", "pos", "barcode"), "points")
    gaps = materialize(windows.character_runs(whole, ["scaffold_id"], "seq", "Nn", least_gap), "gaps")
    kept = whole
    if paf is not None:
        fresh = sets.maximal(named.select("name"), sets.containment(paf)).select("name")
        kept = materialize(whole.join(fresh, "name", "left_semi"), "kept")
    near, far = end_windows(placed, kept, window)
    links = materialize(graph.prune_orientations(joins.end_overlaps(near, far)), "links")
    chained = graph.with_singletons(graph.chains(links, zero_is_none=True), kept.select(F.col("scaffold_id").alias("scaffold")))
    chained = materialize(chained, "chains")
    calibration = windows.calibrate_gaps(placed, named, gaps, window, most_gap)
    before = chained.select("chain", (F.col("ordinal") + 1).alias("ordinal"), F.col("scaffold").alias("a"), (~F.col("reversed")).alias("a_tail"))
    joined = chained.join(before, ["chain", "ordinal"]).select(
        F.struct("chain", "ordinal").alias("join_id"), "a", "a_tail", F.col("scaffold").alias("b"), F.col("reversed").alias("b_tail")
    )
    sizes = windows.estimate_gaps(joined, placed, named, gaps, calibration, window)
    sized = chained.join(sizes.select(F.col("join_id.chain").alias("chain"), F.col("join_id.ordinal").alias("ordinal"), "gap"), ["chain", "ordinal"], "left")
    parts = sized.join(kept.select(F.col("scaffold_id").alias("scaffold"), "name", "seq"), "scaffold").withColumn("gap", F.coalesce("gap", F.lit(0)))
    return {"chains": parts.drop("seq"), "links": links, "text": sinks.scaffold_text(parts, width)}


