"""k-mers: counting with support, spectra, dictionaries and anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions import sequence as S
from braidlake.runtime import map_arrow

#: Windows that are packed at once; longer sequences are cut, with the overlap that their windows need.
WINDOWS = 1 << 18


def exploded(reads: DataFrame, k: int, seq: str = "seq", *keep: str) -> DataFrame:
    """kmer and its position (from 0) for every window of every sequence, beside the columns to keep."""
    return reads.select(*keep, F.posexplode(S.kmers(seq, k)).alias("pos", "kmer"))


def canonical_kmers(reads: DataFrame, k: int, seq: str = "seq", *keep: str, order: str = S.ASSEMBLY_ORDER) -> DataFrame:
    """The same with the canonical form and its strand."""
    rows = exploded(reads, k, seq, *keep)
    return rows.withColumns({"is_rev": S.is_reverse("kmer", order), "kmer": S.canonical("kmer", order)})


def packed(digits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window of k digits (A 0, C 1, G 2, T 3) as a number of two bits a base, and its reverse complement.

    Windows of 1, 2, 4 and so on digits are joined in pairs; those that the bits of k name make up the window.
    """
    one = digits.astype(np.int64)
    ahead, back, width = one, 3 - one, 1
    code, rc, done = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64), 0
    while True:
        if k & width:
            n = len(one) - done - width + 1
            code, rc = code[:n] << 2 * width | ahead[done : done + n], back[done : done + n] << 2 * done | rc[:n]
            done += width
        if 2 * width > k:
            return code, rc
        ahead, back, width = ahead[:-width] << 2 * width | ahead[width:], back[width:] << 2 * width | back[:-width], 2 * width


def summary(reads: DataFrame, k: int, owner: str, seq: str = "seq", next_base: str = "C", previous_base: str = "G", modulus: int = 1_000_003) -> DataFrame:
    """A row an owner with a window of k bases (k up to 31; letters A, C, G, T alone): what all its k-mers come to.

    kmers, reversed (how many have their reverse complement as canonical form), first_canonical, last_canonical,
    codes (the sum of the numbers in the gap closer's order, each modulo ``modulus``), last_next and first_previous
    (the largest successor with ``next_base``, the smallest predecessor with ``previous_base``).

    The windows are packed where the sequence is and never become rows: a sequence sends one row of numbers, a long
    one a row for each ``WINDOWS`` of them. Canonical forms compare in the assembler's order.
    """
    after, before = S.ASSEMBLY_ORDER.index(next_base), S.ASSEMBLY_ORDER.index(previous_base) << 2 * (k - 1)
    mask, odd = (1 << 2 * k) - 1, (1 << 2 * k) // 3
    how = {"kmers": F.sum, "reversed": F.sum, "low": F.min, "high": F.max, "codes": F.sum, "last": F.max, "first": F.min}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digit = np.zeros(256, np.uint8)
        digit[np.frombuffer(S.ASSEMBLY_ORDER.encode(), np.uint8)] = np.arange(4)

        def row(text: bytes) -> list[int]:
            code, rc = packed(digit[np.frombuffer(text, np.uint8)], k)
            low = np.minimum(code, rc)
            # from A, C, G, T to A, C, T, G: G and T change places
            gap = code ^ (code >> 1 & odd)
            return [len(code), int((code >= rc).sum()), int(low.min()), int(low.max()), int((gap % modulus).sum()), int((code << 2 & mask).max()) | after, int((code >> 2).min()) | before]

        for batch in batches:
            owners, rows = [], []
            for i, x in enumerate(batch.column(1)):
                text = (x.as_py() or "").encode()
                for at in range(0, len(text) - k + 1, WINDOWS):
                    owners.append(i)
                    rows.append(row(text[at : at + WINDOWS + k - 1]))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners)), *(pa.array(x, pa.int64()) for x in zip(*rows, strict=True))], names=["owner", *how])

    kind = reads.schema[owner].dataType.simpleString()
    parts = map_arrow(reads.select(F.col(owner).alias("owner"), seq), run, f"owner {kind}, " + ", ".join(f"{x} long" for x in how))
    each = parts.groupBy("owner").agg(*(f(x).alias(x) for x, f in how.items()))
    word = lambda x, name: S.unpack(x, k, S.ASSEMBLY_ORDER).alias(name)
    return each.select(
        F.col("owner").alias(owner), "kmers", "reversed", word("low", "first_canonical"), word("high", "last_canonical"), "codes", word("last", "last_next"), word("first", "first_previous")
    )


def count(reads: DataFrame, k: int, least: int = 3, least_barcodes: int = 2, seq: str = "seq", barcode: str = "barcode", canonical: bool = True) -> DataFrame:
    """kmer, n, barcodes, context of the k-mers with enough support.

    Kept: seen at least ``least`` times, and either in a read with barcode -1 (none known) or in at least
    ``least_barcodes`` distinct barcodes above 0. context has a bit for each base that precedes (1, 2, 4, 8) or
    follows (16 and up) the k-mer somewhere, seen along the canonical strand. Reads shorter than k + 1 don't count.

    Two steps, so that a frequent k-mer is combined by barcode where its rows are.
    """
    longer = reads.where(F.length(seq) >= k + 1)
    # a window and the base on either side of it, so that no row carries its whole sequence
    wide = F.explode(S.kmers(F.concat(F.lit("-"), F.col(seq), F.lit("-")), k + 2))
    rows = longer.select(F.col(barcode).alias("b"), wide.alias("w")).select("b", F.substring("w", 2, k).alias("kmer"), F.substring("w", 1, 1).alias("before"), F.right("w", F.lit(1)).alias("after"))
    before, after = F.col("before"), F.col("after")
    rev = S.is_reverse("kmer") if canonical else F.lit(False)
    first = F.when(rev, S.reverse_complement(after)).otherwise(before)
    last = F.when(rev, S.reverse_complement(before)).otherwise(after)
    flags = bit_of(first, 0).bitwiseOR(bit_of(last, 4))
    key = S.canonical("kmer") if canonical else F.col("kmer")
    per = rows.groupBy(key.alias("kmer"), "b").agg(F.count("*").alias("n"), F.bit_or(flags).alias("context"))
    whole = per.groupBy("kmer").agg(F.sum("n").alias("n"), F.count_if(F.col("b") > 0).alias("barcodes"), F.max((F.col("b") == -1).cast("int")).alias("_open"), F.bit_or("context").alias("context"))
    return whole.where((F.col("n") >= least) & ((F.col("_open") == 1) | (F.col("barcodes") >= least_barcodes))).drop("_open")


def bit_of(base, shift: int):
    """The bit of a base, 0 for none."""
    out = F.lit(0)
    for i, letter in enumerate("ACGT"):
        out = F.when(base == letter, F.lit(1 << (i + shift))).otherwise(out)
    return out


def spectrum(counts: DataFrame, n: str = "n") -> DataFrame:
    """count and kmers: how many k-mers occur how often."""
    return counts.groupBy(F.col(n).alias("count")).agg(F.count("*").alias("kmers"))


def dense_spectrum(spec: DataFrame) -> DataFrame:
    """One row: the spectrum as an array from count 0 to the largest count."""
    top = spec.agg(F.max("count")).first()[0] or 0
    every = spec.sparkSession.range(int(top) + 1).select(F.col("id").alias("count"))
    rows = every.join(spec, "count", "left").select("count", F.coalesce("kmers", F.lit(0)).alias("kmers"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("count", "kmers"))), lambda x: x["kmers"]).alias("vals"))


def spectrum_regions(spec: DataFrame, k: int, ceiling: float = 0.8) -> DataFrame:
    """Peaks and genome size of a spectrum (which is small: one row a count).

    trough: the first local minimum; peak: the largest count above it; snp: the largest between the trough and
    three quarters of the peak, if there is a local maximum; high: twice the peak and a half. genome: k-mers
    above the trough, each count over the peak; repeats: the part of those above one and a half peaks.
    """
    w = Window.orderBy("count")
    rows = spec.withColumns({"before": F.lag("kmers").over(w), "after": F.lead("kmers").over(w)})
    troughs = rows.where("kmers <= coalesce(after, kmers) and kmers < coalesce(before, kmers + 1)")
    trough = troughs.agg(F.coalesce(F.min("count"), F.lit(0))).first()[0]
    above = rows.where(F.col("count") > trough)
    peak = above.agg(F.max_by("count", F.struct("kmers", -F.col("count")))).first()[0]
    all_ = above.withColumns({"trough": F.lit(trough), "peak": F.lit(peak)})
    snp = F.max_by("count", F.when((F.col("count") < 0.75 * F.col("peak")) & (F.col("kmers") > F.coalesce("before", F.lit(0))) & (F.col("kmers") > F.coalesce("after", F.lit(0))), F.struct("kmers", "count")))
    return all_.groupBy("trough", "peak").agg(
        snp.alias("snp"),
        F.sum(F.col("count") * F.col("kmers") / F.col("peak")).alias("genome"),
        F.sum(F.when(F.col("count") > 1.5 * F.col("peak"), F.col("count") * F.col("kmers") / F.col("peak")).otherwise(0.0)).alias("repeats"),
    ).withColumn("high", F.floor(2.5 * F.col("peak")).cast("long"))


def unique_anchors(contigs: DataFrame, k: int = 25, seq: str = "seq", owner: str = "contig_id") -> DataFrame:
    """kmer, owner, pos and strand of the canonical k-mers that occur once in all contigs."""
    rows = canonical_kmers(contigs, k, seq, owner, order=S.GAP_ORDER)
    per = rows.groupBy("kmer").agg(F.count("*").alias("_n"), F.first(F.struct(owner, "pos", "is_rev")).alias("_at"))
    return per.where("_n = 1").select("kmer", F.col(f"_at.{owner}").alias(owner), F.col("_at.pos").alias("contig_pos"), F.col("_at.is_rev").alias("contig_rev"))


def anchor_reads(reads: DataFrame, anchors: DataFrame, k: int = 25, seq: str = "seq", read: str = "read_id") -> DataFrame:
    """Positions of reads whose k-mer is an anchor. ``reverse``: the read runs against the contig."""
    rows = canonical_kmers(reads, k, seq, read, order=S.GAP_ORDER)
    return rows.join(anchors, "kmer").withColumn("reverse", F.col("is_rev") != F.col("contig_rev")).drop("is_rev", "contig_rev")


def anchor_statistics(contigs: DataFrame, k: int = 25, seq: str = "seq") -> DataFrame:
    """total and unique distinct k-mers."""
    per = canonical_kmers(contigs, k, seq, order=S.GAP_ORDER).groupBy("kmer").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("total"), F.count_if(F.col("n") == 1).alias("unique"))


def paths_of(reads: DataFrame, dictionary: DataFrame, k: int, seq: str = "seq", read: str = "read_id") -> DataFrame:
    """Reads as runs along edges. dictionary: kmer, edge, offset. Result: read, ordinal, edge, start, stop, offset.

    Consecutive k-mers on one edge and diagonal (offset - pos) are one run; start and stop are read positions.
    """
    hits = exploded(reads, k, seq, read).join(dictionary, "kmer").withColumn("diagonal", F.col("offset") - F.col("pos"))
    runs = hits.groupBy(read, "edge", "diagonal").agg(F.min("pos").alias("start"), (F.max("pos") + k).alias("stop"), F.min("offset").alias("offset"), F.count("*").alias("kmers"))
    return runs.withColumn("ordinal", F.row_number().over(Window.partitionBy(read).orderBy("start", "edge", "diagonal")) - 1).drop("diagonal")


def friends(reads: DataFrame, k: int, most: int, seq: str = "seq", read: str = "read_id") -> DataFrame:
    """a < b: reads that share k-mers, and how many; k-mers in more than ``most`` reads are repeats and don't count."""
    from .joins import overlap_pairs

    rows = canonical_kmers(reads, k, seq, read).select(F.col(read).alias("owner"), F.col("kmer").alias("item")).distinct()
    return overlap_pairs(rows, most=most).select("a", "b", "common")


def diagonals(reads: DataFrame, targets: DataFrame, k: int, most: int = 100, least: int = 2) -> DataFrame:
    """Alignments of reads to targets from shared k-mers: read_id, target, diagonal, kmers, start, stop.

    k-mers with more than ``most`` places in the targets are left out; a diagonal needs ``least`` k-mers.
    """
    places = exploded(targets, k, "seq", "target").withColumnRenamed("pos", "at")
    rare = places.withColumn("_n", F.count("*").over(Window.partitionBy("kmer"))).where(F.col("_n") <= most).drop("_n")
    hits = exploded(reads, k, "seq", "read_id").join(rare, "kmer")
    found = hits.groupBy("read_id", "target", (F.col("at") - F.col("pos")).alias("diagonal")).agg(F.count("*").alias("kmers"), F.min("at").alias("start"), (F.max("at") + k).alias("stop"))
    return found.where(F.col("kmers") >= least)
