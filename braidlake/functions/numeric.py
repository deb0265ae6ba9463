"""Numeric, interval and probability expressions. All stay in the JVM unless they say otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import col


def overlap(a_start: Column, a_stop: Column, b_start: Column, b_stop: Column) -> Column:
    """Shared length of two half-open intervals."""
    return F.greatest(F.lit(0), F.least(a_stop, b_stop) - F.greatest(a_start, b_start))


def gap_between(a_start: Column, a_stop: Column, b_start: Column, b_stop: Column) -> Column:
    """Distance of two half-open intervals; 0 where they touch or overlap."""
    return F.greatest(F.lit(0), F.greatest(a_start, b_start) - F.least(a_stop, b_stop))


def contains(a_start: Column, a_stop: Column, b_start: Column, b_stop: Column) -> Column:
    """Whether the second interval lies within the first."""
    return (a_start <= b_start) & (b_stop <= a_stop)


def span(a_start: Column, a_stop: Column, b_start: Column, b_stop: Column) -> Column:
    """The smallest interval that holds both."""
    return F.struct(F.least(a_start, b_start).alias("start"), F.greatest(a_stop, b_stop).alias("stop"))


def midpoint(start: Column | str, stop: Column | str) -> Column:
    """Integer middle of an alignment."""
    return F.floor((col(start) + col(stop)) / 2).cast("long")


def mirrored(pos: Column | str, length: Column | str) -> Column:
    """A coordinate seen from the other end."""
    return col(length) - col(pos) - 1


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two arrays; null if either is all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(col(a), col(a)) * dot(col(b), col(b)))
    return F.when(size > 0, dot(col(a), col(b)) / size)


def error_probability(quality: Column | str, most: int = 33) -> Column:
    """Chance that a base of this quality is wrong, qualities above ``most`` counting as that."""
    return F.pow(F.lit(10.0), -F.least(col(quality), F.lit(most)) / 10.0)


def quality_score(correct: Column | str, wrong: Column | str) -> Column:
    """Phred score of a rate of errors, with one error and one success added."""
    return -10 * F.log10((col(wrong) + 1.0) / (col(correct) + col(wrong) + 2.0))


def poisson_pmf(count: Column | str, mean: Column | str) -> Column:
    k, m = col(count), col(mean)
    return F.exp(k * F.log(m) - m - ln_factorial(k))


def ln_factorial(n: Column | str) -> Column:
    """Natural log of a factorial: exact sums to 20, Stirling's series beyond."""
    exact = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(21)])
    x = col(n).cast("double") + 1
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0)))
    return F.when(col(n) <= 20, F.get(exact, col(n).cast("int"))).otherwise(series)


def choose(n: Column | str, k: Column | str) -> Column:
    return F.exp(ln_factorial(n) - ln_factorial(k) - ln_factorial(col(n) - col(k)))


def binomial_pmf(count: Column | str, trials: Column | str, p: Column | float) -> Column:
    p = F.lit(p) if isinstance(p, float) else p
    return choose(trials, count) * F.pow(p, col(count)) * F.pow(1 - p, col(trials) - col(count))


def poisson_cdf(count: Column | str, mean: Column | str) -> Column:
    """Chance of at most ``count`` events; terms are added up in the JVM."""
    terms = F.transform(F.sequence(F.lit(0), col(count).cast("int")), lambda i: poisson_pmf(i, mean))
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


def normal_cdf(x: Column | str) -> Column:
    """Standard normal distribution function, to 7.5e-8 (Abramowitz and Stegun 26.2.17)."""
    z = F.abs(col(x).cast("double"))
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(col(x) >= 0, 1 - upper).otherwise(upper)


def combine_normals(mean_a: Column, sd_a: Column, mean_b: Column, sd_b: Column) -> Column:
    """Two measurements of one quantity, each weighted by its inverse variance."""
    wa, wb = 1 / (sd_a * sd_a), 1 / (sd_b * sd_b)
    return F.struct(((mean_a * wa + mean_b * wb) / (wa + wb)).alias("mean"), F.sqrt(1 / (wa + wb)).alias("sd"))


def gcd(a: Column | str, b: Column | str) -> Column:
    """Greatest common divisor of two longs; Euclid's steps are folded over a bounded range."""
    state = F.struct(F.abs(col(a)).cast("long").alias("x"), F.abs(col(b)).cast("long").alias("y"))
    step = lambda s, _: F.struct(
        F.when(s["y"] == 0, s["x"]).otherwise(s["y"]).alias("x"), F.when(s["y"] == 0, F.lit(0).cast("long")).otherwise(F.pmod(s["x"], s["y"])).alias("y")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(92)), state, step)["x"]


# CIGAR strings

OPERATIONS = "([0-9]+)([MIDNSHP=X])"


def cigar_length(cigar: Column | str, kinds: str) -> Column:
    """Summed length of the operations of these kinds."""
    sizes = F.regexp_extract_all(col(cigar), F.lit(f"([0-9]+)[{kinds}]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def reference_length(cigar: Column | str) -> Column:
    return cigar_length(cigar, "MDN=X")


def query_length(cigar: Column | str) -> Column:
    return cigar_length(cigar, "MIS=X")


def cigar_reverse(cigar: Column | str) -> Column:
    return F.concat_ws("", F.reverse(F.regexp_extract_all(col(cigar), F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))))


def unclipped(cigar: Column | str) -> Column:
    """Soft clips count as matches."""
    return merged_cigar(F.translate(col(cigar), "S", "M"))


def merged_cigar(cigar: Column | str) -> Column:
    """Neighbouring operations of one kind joined, empty ones dropped."""
    ops = F.regexp_extract_all(col(cigar), F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))
    parts = F.filter(F.transform(ops, lambda o: F.struct(F.regexp_extract(o, "^([0-9]+)", 1).cast("long").alias("n"), F.right(o, F.lit(1)).alias("k"))), lambda o: o["n"] > 0)
    empty = F.array().cast("array<struct<n:bigint,k:string>>")
    joined = F.aggregate(
        parts,
        empty,
        lambda s, o: F.when(
            (F.size(s) > 0) & (F.try_element_at(s, F.lit(-1))["k"] == o["k"]),
            F.concat(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.struct((F.try_element_at(s, F.lit(-1))["n"] + o["n"]).alias("n"), o["k"].alias("k")))),
        ).otherwise(F.concat(s, F.array(F.struct(o["n"].alias("n"), o["k"].alias("k"))))),
    )
    return F.concat_ws("", F.transform(joined, lambda o: F.concat(o["n"].cast("string"), o["k"])))
