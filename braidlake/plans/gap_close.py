"""Closing gaps with long reads: contigs, anchors, runs along a read, gap sizes and fillers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.sequence import reverse_complement
from braidlake.operators import kmers
from braidlake.runtime import materialize
from braidlake.sources import sinks

K = 25
#: Anchors that outvote the other strand so many times give a run its direction.
MAJORITY = 20
#: A node that doesn't fit is dropped below so many anchors; from there on the read is misleading.
TRUSTED = 100


def contigs(scaffolds: DataFrame, scaffold: str = "scaffold_id", seq: str = "seq") -> DataFrame:
    """The called stretches of each scaffold: scaffold_id, ordinal, start, pre_gap (N before it), seq, contig_id.

    contig_id is scaffold_id * 2**24 + ordinal.
    """
    parts = F.regexp_extract_all(F.col(seq), F.lit("[Nn]*[^Nn]+"), F.lit(0))
    cut = scaffolds.select(F.col(scaffold).alias("scaffold_id"), F.posexplode(parts).alias("ordinal", "p"))
    own = F.regexp_replace("p", "^[Nn]+", "")
    rows = cut.select("scaffold_id", "ordinal", (F.length("p") - F.length(own)).alias("pre_gap"), own.alias("seq"), F.length("p").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("scaffold_id").orderBy("ordinal"))
    return rows.withColumn("start", upto - F.length("seq")).withColumn("contig_id", F.col("scaffold_id") * (1 << 24) + F.col("ordinal")).drop("_n")


def read_runs(anchors: DataFrame, k: int = K) -> DataFrame:
    """Runs of consecutive anchors of one contig along a read, with a direction.

    anchors: read_id, pos, contig_id, contig_pos, reverse. Result: read_id, node, contig_id, reverse, anchors and the
    bounds left_read, right_read, left_contig, right_contig of the anchors of the winning direction. Runs without
    such a majority are dropped.
    """
    order = Window.partitionBy("read_id").orderBy("pos")
    change = F.coalesce((F.col("contig_id") != F.lag("contig_id").over(order)).cast("int"), F.lit(0))
    runs = anchors.withColumn("_c", change).withColumn("node", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    votes = runs.groupBy("read_id", "node", "contig_id").agg(
        F.count_if("reverse").alias("r"), F.count_if(~F.col("reverse")).alias("f"),
        *[F.struct(F.min(F.when(c, F.col("pos"))).alias("lr"), F.max(F.when(c, F.col("pos"))).alias("rr"), F.min(F.when(c, F.col("contig_pos"))).alias("lc"), F.max(F.when(c, F.col("contig_pos"))).alias("rc")).alias(n)
          for n, c in (("fwd", ~F.col("reverse")), ("rev", F.col("reverse")))],
    )
    sure = votes.where((F.col("f") >= MAJORITY * F.col("r")) | (F.col("r") >= MAJORITY * F.col("f")))
    reverse = F.col("r") > F.col("f")
    side = lambda x: F.when(reverse, F.col(f"rev.{x}")).otherwise(F.col(f"fwd.{x}"))
    return sure.select(
        "read_id", "node", "contig_id", reverse.alias("reverse"), F.greatest("f", "r").alias("anchors"), side("lr").alias("left_read"), (side("rr") + k).alias("right_read"),
        side("lc").alias("left_contig"), (side("rc") + k).alias("right_contig"),
    )


def extended(runs: DataFrame, chain: DataFrame) -> DataFrame:
    """The runs of each read that agree with its strongest one, and their order along the contigs.

    chain: contig_id, scaffold_id, ordinal. From the strongest run (ties: the first) both ways, a run belongs if it
    has the same direction and the next contig of the scaffold in that direction. One that doesn't is passed over
    with fewer than 100 anchors; with more the read is misleading, and gives nothing. A read has few runs, which are
    walked together.
    """
    from functools import partial

    joined = runs.join(chain.select("contig_id", "scaffold_id", "ordinal"), "contig_id")
    schema = joined.select("read_id", "node", "contig_id", "scaffold_id", "ordinal", "reverse", "anchors", "left_read", "right_read", "left_contig", "right_contig").schema
    return joined.select(*schema.names).groupBy("read_id").applyInPandas(partial(_walked), schema)


def _walked(rows):
    rows = rows.sort_values("node").reset_index(drop=True)
    top = int(rows["anchors"].to_numpy().argmax())
    best, kept = rows.loc[top], [top]
    for way in (1, -1):
        last = best
        for i in range(top + way, len(rows) if way > 0 else -1, way):
            row = rows.loc[i]
            step = way if not best["reverse"] else -way
            fits = row["reverse"] == best["reverse"] and row["scaffold_id"] == last["scaffold_id"] and row["ordinal"] == last["ordinal"] + step
            if fits:
                kept.append(i)
                last = row
            elif row["anchors"] >= TRUSTED:
                return rows.iloc[:0]
    return rows.loc[sorted(kept)]


def gap_evidence(walked: DataFrame, chain: DataFrame) -> DataFrame:
    """scaffold_id, ordinal (of the contig after the gap), read_id, reverse, size, from_read, to_read.

    The size is what of the read between two neighbouring runs isn't of either contig; where it is positive, the
    filler is the read from from_read to to_read. chain also has seq.
    """
    order = Window.partitionBy("read_id").orderBy("node")
    lengths = chain.select("contig_id", F.length("seq").alias("contig_length"))
    rows = walked.join(lengths, "contig_id").withColumn("next", F.lead(F.struct("contig_id", "scaffold_id", "ordinal", "left_read", "left_contig", "right_contig", "contig_length")).over(order)).where("next is not null")
    # what is left of either contig beyond its outer anchors, seen along the read
    behind = F.when(F.col("reverse"), F.col("left_contig")).otherwise(F.col("contig_length") - F.col("right_contig"))
    ahead = F.when(F.col("reverse"), F.col("next.contig_length") - F.col("next.right_contig")).otherwise(F.col("next.left_contig"))
    span = F.col("next.left_read") - F.col("right_read")
    return rows.select(
        "scaffold_id", F.greatest(F.col("ordinal"), F.col("next.ordinal")).alias("ordinal"), "read_id", "reverse", (span - behind - ahead).alias("size"),
        (F.col("right_read") + behind).alias("from_read"), (F.col("next.left_read") - ahead).alias("to_read"),
    )


def median_evidence(evidence: DataFrame) -> DataFrame:
    """For each gap the evidence in the upper middle when sorted by size (then read), and how many there are."""
    order = Window.partitionBy("scaffold_id", "ordinal").orderBy("size", "read_id")
    ranked = evidence.withColumns({"_r": F.row_number().over(order) - 1, "support": F.count("*").over(Window.partitionBy("scaffold_id", "ordinal"))})
    return ranked.where("_r = support div 2").drop("_r")


def fillers(medians: DataFrame, reads: DataFrame) -> DataFrame:
    """scaffold_id, ordinal, size, support and filler; an overlap (size 0 or less) has an empty one."""
    raw = F.expr("substr(seq, from_read + 1, to_read - from_read)")
    joined = medians.join(reads.select("read_id", "seq"), "read_id")
    filler = F.when(F.col("size") > 0, F.when(F.col("reverse"), reverse_complement(raw)).otherwise(raw)).otherwise("")
    return joined.select("scaffold_id", "ordinal", "size", "support", filler.alias("filler"))


def closed(chain: DataFrame, filled: DataFrame) -> DataFrame:
    """scaffold_id, seq with gaps replaced by their fillers; gaps without evidence keep their N, overlaps are closed up.

    A negative size cuts as many bases of the contig after it.
    """
    rows = chain.join(filled, ["scaffold_id", "ordinal"], "left")
    gap = F.when(F.col("ordinal") == 0, F.repeat(F.lit("N"), F.col("pre_gap"))).otherwise(F.coalesce("filler", F.repeat(F.lit("N"), F.col("pre_gap"))))
    own = F.when((F.col("size") < 0) & (F.col("ordinal") > 0), F.expr("substr(seq, 1 - cast(size as int))")).otherwise(F.col("seq"))
    parts = F.array_sort(F.collect_list(F.struct("ordinal", F.concat(gap, own).alias("p"))))
    return rows.groupBy("scaffold_id").agg(F.concat_ws("", F.transform(parts, lambda x: x["p"])).alias("seq"))


def run(scaffolds: DataFrame, reads: DataFrame, k: int = K, width: int = 60) -> dict[str, DataFrame]:
    """All steps. scaffolds: scaffold_id, name, seq. reads: read_id, seq. Gives 'fillers', 'scaffolds' and 'text'."""
    chain = materialize(contigs(scaffolds), "contigs")
    anchors = kmers.anchor_reads(reads, kmers.unique_anchors(chain, k), k)
    runs = read_runs(anchors, k)
    evidence = gap_evidence(extended(runs, chain), chain)
    filled = materialize(fillers(median_evidence(evidence), reads), "fillers")
    whole = closed(chain, filled).join(scaffolds.select("scaffold_id", "name"), "scaffold_id")
    return {"fillers": filled, "scaffolds": whole, "text": sinks.fasta_text(whole, width, 0)}
