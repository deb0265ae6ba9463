"""Column expressions over sequences, qualities and barcodes. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base of the positional barcode number: segments count from 1 to 1536.
SEGMENT_BASE = 1537
#: Order of bases in packed k-mers of the gap closer.
GAP_ORDER = "ACTG"
#: Order of bases in packed k-mers of the assembler.
ASSEMBLY_ORDER = "ACGT"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def phred(quals: Column | str, offset: int = 33) -> Column:
    """Array of qualities of a quality string; line ends are dropped."""
    chars = F.filter(F.split(F.regexp_replace(col(quals), "[\r\n]", ""), ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c) - offset)


def n_to_a(seq: Column | str) -> Column:
    """Bases that were not called become A."""
    return F.translate(col(seq), "Nn", "AA")


def reverse_complement(seq: Column | str) -> Column:
    """The other strand, in upper case; letters that are no base stay."""
    return F.reverse(F.translate(col(seq), "ACGTacgt", "TGCATGCA"))


def ordered(seq: Column, order: str) -> Column:
    """Digits that compare as the bases do in an alphabet's order."""
    return F.translate(seq, order, "0123")


def is_reverse(kmer: Column | str, order: str = ASSEMBLY_ORDER) -> Column:
    """Whether the canonical form is the reverse complement; a palindrome counts as one."""
    k = col(kmer)
    return ordered(k, order) >= ordered(reverse_complement(k), order)


def canonical(kmer: Column | str, order: str = ASSEMBLY_ORDER) -> Column:
    """The smaller of a k-mer and its reverse complement in the alphabet's order."""
    k = col(kmer)
    return F.when(is_reverse(k, order), reverse_complement(k)).otherwise(k)


def kmers(seq: Column | str, k: int) -> Column:
    """All windows of k characters, in order.

    A lookahead finds them in one pass; taking substrings by position would read each string from its start anew.
    """
    return F.regexp_extract_all(col(seq), F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def pack(kmer: Column | str, order: str = GAP_ORDER) -> Column:
    """Two bits a base, for up to 31 bases."""
    return F.conv(ordered(col(kmer), order), 4, 10).cast("long")


def unpack(code: Column | str, k: int, order: str = GAP_ORDER) -> Column:
    return F.translate(F.lpad(F.conv(col(code).cast("string"), 10, 4), k, "0"), "0123", order)


def successor(kmer: Column | str, base: Column | str) -> Column:
    """The k-mer one base on."""
    return F.concat(F.substr(col(kmer), F.lit(2)), col(base))


def predecessor(kmer: Column | str, base: Column | str) -> Column:
    """The k-mer one base before."""
    k = col(kmer)
    return F.concat(col(base), F.substr(k, F.lit(1), F.length(k) - 1))


def kmer_shard(kmer: Column | str, shards: int) -> Column:
    """The shard that owns a k-mer."""
    return (F.crc32(col(kmer)) % shards).cast("int")


def is_uncalled(base: Column | str) -> Column:
    return F.upper(col(base)) == "N"


def segments(barcode: Column | str) -> list[Column]:
    parts = F.split(col(barcode), "_")
    return [F.get(parts, i).cast("long") for i in range(3)]


def barcode_id(barcode: Column | str) -> Column:
    """``b1_b2_b3`` as one number; ``0_0_0`` is 0, the barcode of reads without one."""
    a, b, c = segments(barcode)
    return a * SEGMENT_BASE * SEGMENT_BASE + b * SEGMENT_BASE + c


def packed_barcode(barcode: Column | str) -> Column:
    """The gap closer's number of a barcode: twenty bits a segment."""
    a, b, c = segments(barcode)
    return F.shiftleft(a, 40).bitwiseOR(F.shiftleft(b, 20)).bitwiseOR(c)


def good_length(quals: Column | str, run: int, least: int) -> Column:
    """Length of the longest prefix that ends with ``run`` qualities of at least ``least``; 0 if none does."""
    flags = F.concat_ws("", F.transform(col(quals), lambda q: F.when(q >= least, "1").otherwise("0")))
    return F.length(F.regexp_extract(flags, f"^(.*1{{{run}}})", 1))


def trim(seq: Column | str, count: Column | int) -> Column:
    """A sequence or a quality string without its first bases."""
    n = F.lit(count) if isinstance(count, int) else count
    return F.substr(col(seq), n + 1)


#: Bases that each IUPAC letter stands for, as bits of A, C, G, T.
IUPAC_BITS = {"A": 1, "C": 2, "M": 3, "G": 4, "R": 5, "S": 6, "V": 7, "T": 8, "W": 9, "Y": 10, "H": 11, "K": 12, "D": 13, "B": 14, "N": 15}


def iupac_bits(base: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for item in IUPAC_BITS.items() for x in item])
    return table[F.upper(col(base))]


def iupac_letter(bits: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in IUPAC_BITS.items() for x in (v, k)])
    return table[col(bits).cast("int")]


def mismatches(a: Column | str, b: Column | str) -> Column:
    """Positions in which two strings of equal length differ."""
    pairs = F.zip_with(F.split(col(a), ""), F.split(col(b), ""), lambda x, y: (x != y).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + x)


def neighbours(word: Column | str, alphabet: str = "ACGT") -> Column:
    """All strings that differ from a word in exactly one position."""
    w = col(word)
    letters = F.array(*[F.lit(c) for c in alphabet])
    at = F.sequence(F.lit(1), F.length(w))
    made = F.flatten(
        F.transform(
            at,
            lambda i: F.transform(
                F.filter(letters, lambda c: c != F.substring(w, i, F.lit(1))),
                lambda c: F.concat(F.substring(w, F.lit(1), i - 1), c, F.substr(w, i + 1)),
            ),
        )
    )
    return F.when(F.length(w) > 0, made).otherwise(F.array().cast("array<string>"))


def second_neighbours(word: Column | str, alphabet: str = "ACGT") -> Column:
    """All strings that differ from a word in exactly two positions, each once: one change and another behind it."""
    w = col(word)
    letters = F.array(*[F.lit(c) for c in alphabet])
    rest = lambda i: F.substr(w, i + 1)
    made = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(w) - 1),
            lambda i: F.flatten(
                F.transform(
                    F.filter(letters, lambda c: c != F.substring(w, i, F.lit(1))),
                    lambda c: F.transform(neighbours(rest(i), alphabet), lambda t: F.concat(F.substring(w, F.lit(1), i - 1), c, t)),
                )
            ),
        )
    )
    return F.when(F.length(w) > 1, made).otherwise(F.array().cast("array<string>"))


def wrap(seq: Column | str, width: int) -> Column:
    """A sequence in lines of at most ``width`` characters."""
    return F.regexp_replace(col(seq), f"(.{{{width}}})(?=.)", "$1\n")
