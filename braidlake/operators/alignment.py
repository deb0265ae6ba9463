"""Pairwise alignment scores, pile-ups, column consensus and read correction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.functions import sequence as S
from braidlake.runtime import map_arrow

from . import kmers, nstats

ALIGNED = "score int, query_start int, query_stop int, target_start int, target_stop int, cigar string"


def align(query: str, target: str, match: int = 1, mismatch: int = -3, open_: int = -5, extend: int = -2, mode: str = "local", band: int | None = None) -> tuple[int, int, int, int, int, str]:
    """Affine-gap alignment. mode: 'local', 'free' (ends of either side cost nothing) or 'global'.

    band limits how far the diagonal may drift. Result: score, half-open bounds in both, CIGAR (D: bases of the
    target alone). Among equal ways a match comes before a deletion and that before an insertion.
    """
    n, m, low = len(query), len(target), -(10**9)
    a, b = np.frombuffer(query.encode(), np.uint8), np.frombuffer(target.encode(), np.uint8)
    best, gap_t, gap_q = (np.full((n + 1, m + 1), low, np.int64) for _ in range(3))
    trace = np.zeros((n + 1, m + 1), np.uint8)
    edge = lambda k: 0 if k == 0 or mode != "global" else open_ + extend * (k - 1)
    best[0] = [edge(j) for j in range(m + 1)]
    best[:, 0] = [edge(i) for i in range(n + 1)]
    for i in range(1, n + 1):
        first, last = (1, m) if band is None else (max(1, i - band), min(m, i + band))
        pair = np.where(b == a[i - 1], match, mismatch)
        for j in range(first, last + 1):
            gap_t[i, j] = max(best[i, j - 1] + open_, gap_t[i, j - 1] + extend)
            gap_q[i, j] = max(best[i - 1, j] + open_, gap_q[i - 1, j] + extend)
            ways = (best[i - 1, j - 1] + pair[j - 1], gap_t[i, j], gap_q[i, j])
            k = int(np.argmax(ways))
            best[i, j], trace[i, j] = ways[k], k + 1
            if mode == "local" and best[i, j] <= 0:
                best[i, j], trace[i, j] = 0, 0
    if mode == "local":
        i, j = np.unravel_index(int(best.argmax()), best.shape)
    elif mode == "free":
        ends = [(best[n, j], n, j) for j in range(m + 1)] + [(best[i, m], i, m) for i in range(n)]
        _, i, j = max(ends, key=lambda e: (e[0], -e[1], -e[2]))
    else:
        i, j = n, m
    i, j = int(i), int(j)
    score, stop_q, stop_t, ops = int(best[i, j]), i, j, []
    while i > 0 and j > 0 and trace[i, j]:
        if trace[i, j] == 1:
            ops.append("M")
            i, j = i - 1, j - 1
        elif trace[i, j] == 2:
            k = j
            while True:
                ops.append("D")
                k -= 1
                if gap_t[i, k + 1] == best[i, k] + open_:
                    break
            j = k
        else:
            k = i
            while True:
                ops.append("I")
                k -= 1
                if gap_q[k + 1, j] == best[k, j] + open_:
                    break
            i = k
    if mode == "global":
        ops += ["D"] * j + ["I"] * i
        i = j = 0
    runs: list[list] = []
    for o in reversed(ops):
        if runs and runs[-1][1] == o:
            runs[-1][0] += 1
        else:
            runs.append([1, o])
    return score, i, stop_q, j, stop_t, "".join(f"{k}{o}" for k, o in runs)


def aligned(pairs: DataFrame, query: str = "query", target: str = "target", **options) -> DataFrame:
    """pairs and the alignment of their two sequences; null if either is."""
    added = T.StructType.fromDDL(ALIGNED)
    schema = T.StructType([*pairs.schema.fields, *added.fields])
    at = (pairs.columns.index(query), pairs.columns.index(target))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [align(q, t, **options) if q is not None and t is not None else (None,) * 6 for q, t in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist(), strict=True)]
            kinds = [pa.int32()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[k] for f in found], t) for k, t in enumerate(kinds))], names=schema.names)

    return map_arrow(pairs, run, schema)


def pileup(alignments: DataFrame, least: int = 0) -> DataFrame:
    """rname, pos, base, quality of every aligned base. alignments: as ``sources.text.sam`` gives them."""
    ops = F.regexp_extract_all("cigar", F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))
    empty = F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.array().cast("array<struct<r:int,q:int,n:int>>").alias("m"))
    size = lambda o: F.regexp_extract(o, "^([0-9]+)", 1).cast("int")
    step = lambda s, o: F.struct(
        (s["r"] + F.when(o.rlike("[MDN=X]$"), size(o)).otherwise(0)).alias("r"),
        (s["q"] + F.when(o.rlike("[MIS=X]$"), size(o)).otherwise(0)).alias("q"),
        F.when(o.rlike("[M=X]$"), F.concat(s["m"], F.array(F.struct(s["r"].alias("r"), s["q"].alias("q"), size(o).alias("n"))))).otherwise(s["m"]).alias("m"),
    )
    blocks = alignments.where((F.col("mapq") >= least) & ~F.col("unmapped") & (F.col("cigar") != "*")).withColumn("b", F.explode(F.aggregate(ops, empty, step)["m"]))
    own = blocks.select("rname", (F.col("pos") + F.col("b.r")).alias("at"), F.expr("substr(seq, b.q + 1, b.n)").alias("s"), F.when(F.col("qual") != "*", F.expr("substr(qual, b.q + 1, b.n)")).alias("u"))
    letters = own.select("rname", "at", "u", F.posexplode(F.filter(F.split("s", ""), lambda c: c != "")).alias("i", "base"))
    return letters.select("rname", (F.col("at") + F.col("i")).alias("pos"), "base", (F.ascii(F.expr("substr(u, i + 1, 1)")) - 33).alias("quality"))


def consensus(columns: DataFrame, share: float = 0.0) -> DataFrame:
    """rname, pos, base, depth, weight: the base of most quality in each column (ties: the first), N below ``share``.

    columns: rname, pos, base, quality (null counts 1). Bases are added up before columns are compared.
    """
    per = columns.groupBy("rname", "pos", "base").agg(F.count("*").alias("n"), F.sum(F.coalesce("quality", F.lit(1))).alias("w"))
    best = per.groupBy("rname", "pos").agg(F.min(F.struct((-F.col("w")).alias("w"), "base")).alias("b"), F.sum("n").alias("depth"), F.sum("w").alias("all"))
    base = F.when(-F.col("b.w") >= share * F.col("all"), F.col("b.base")).otherwise("N")
    return best.select("rname", "pos", base.alias("base"), "depth", (-F.col("b.w")).alias("weight"))


def consensus_sequences(columns: DataFrame) -> DataFrame:
    """rname, seq from the consensus of every column, in order; columns without reads are left out."""
    rows = columns.groupBy("rname").agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("p"))
    return rows.select("rname", F.concat_ws("", F.transform("p", lambda x: x["base"])).alias("seq"))


def error_candidates(reads: DataFrame, k: int, rare: int = 1, solid: int = 3, seq: str = "seq", read: str = "read_id") -> DataFrame:
    """read, pos, base, correct: bases in the middle of rare k-mers that one solid k-mer explains.

    k is odd. A k-mer seen at most ``rare`` times in all reads is an error if exactly one base in its middle makes
    it one that is seen at least ``solid`` times. Both strands count together. N is a letter of its own here: put A for
    it first (``functions.sequence.n_to_a``) where uncalled bases aren't to be filled in.
    """
    half = k // 2
    rows = kmers.exploded(reads, k, seq, read)
    counts = rows.groupBy(S.canonical("kmer").alias("c")).agg(F.count("*").alias("n"))
    firm = counts.where(F.col("n") >= solid).select("c")
    weak = rows.withColumn("c", S.canonical("kmer")).join(counts.where(F.col("n") <= rare).select("c"), "c").drop("c")
    middle = F.substring("kmer", half + 1, 1)
    tried = weak.withColumn("correct", F.explode(F.array(*[F.lit(b) for b in "ACGT"]))).where(F.col("correct") != middle)
    changed = F.concat(F.substring("kmer", 1, half), F.col("correct"), F.substr("kmer", F.lit(half + 2)))
    hits = tried.withColumn("c", S.canonical(changed)).join(firm, "c")
    per = hits.groupBy(read, "pos", "kmer").agg(F.count("*").alias("n"), F.min("correct").alias("correct")).where("n = 1")
    return per.select(read, (F.col("pos") + half).alias("pos"), middle.alias("base"), "correct")


def corrected(reads: DataFrame, changes: DataFrame, seq: str = "seq", read: str = "read_id") -> DataFrame:
    """Reads with the bases of ``error_candidates`` put right."""
    per = changes.groupBy(read).agg(F.map_from_entries(F.collect_list(F.struct("pos", "correct"))).alias("_c"))
    letters = F.transform(F.filter(F.split(seq, ""), lambda c: c != ""), lambda c, i: F.coalesce(F.col("_c")[i], c))
    return reads.join(per, read, "left").withColumn(seq, F.when(F.col("_c").isNull(), F.col(seq)).otherwise(F.concat_ws("", letters))).drop("_c")


def perfect_stretches(columns: DataFrame, reference: DataFrame) -> DataFrame:
    """N50 of stretches of a consensus without a difference, and differences per kilobase.

    columns: rname, pos, base. reference: rname, pos, base.
    """
    both = reference.withColumnRenamed("base", "want").join(columns, ["rname", "pos"], "left").withColumn("same", F.coalesce(F.col("want") == F.col("base"), F.lit(False)))
    rate = both.agg(F.try_divide(1000 * F.count_if(~F.col("same")), F.count("*"))).first()[0]
    order = Window.partitionBy("rname").orderBy("pos")
    runs = both.withColumn("run", F.sum((~F.col("same")).cast("int")).over(order)).where("same").groupBy("rname", "run").agg(F.count("*").alias("length"))
    return nstats.n50(runs, "length", name="perfect_n50").withColumn("errors_per_kb", F.lit(rate))


def misjoins(alignments: DataFrame, most: int = 10_000) -> DataFrame:
    """query, breaks: neighbouring alignments of a sequence to places that don't fit: another target or strand, or a
    jump that differs by more than ``most`` from the step along the sequence. alignments: as ``sources.text.paf``."""
    order = Window.partitionBy("q").orderBy("qs", "qe")
    last = F.lag(F.struct("t", "strand", "ts", "te", "qe")).over(order)
    rows = alignments.withColumn("_l", last).where("_l is not null")
    jump = F.when(F.col("strand") == "+", F.col("ts") - F.col("_l.te")).otherwise(F.col("_l.ts") - F.col("te"))
    fits = (F.col("t") == F.col("_l.t")) & (F.col("strand") == F.col("_l.strand")) & (F.abs(jump - (F.col("qs") - F.col("_l.qe"))) <= most)
    return rows.groupBy("q").agg(F.count_if(~fits).alias("breaks"))
