"""Sequences with alternatives: ``AC{G,TT}A`` and IUPAC letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import col


def parts(seq: Column | str) -> Column:
    """Runs and sets of alternatives, in order, each an array of strings."""
    found = F.regexp_extract_all(col(seq), F.lit(r"(\{[^}]*\}|[^{]+)"), F.lit(1))
    return F.transform(found, lambda p: F.when(p.startswith("{"), F.split(F.substr(p, F.lit(2), F.length(p) - 2), ",")).otherwise(F.array(p)))


def first_version(seq: Column | str) -> Column:
    """The sequence with the first of all alternatives."""
    return F.concat_ws("", F.transform(parts(seq), lambda p: F.element_at(p, 1)))


def versions(seq: Column | str) -> Column:
    """All sequences; for few sets of alternatives, as they multiply."""
    return F.aggregate(parts(seq), F.array(F.lit("")), lambda s, p: F.flatten(F.transform(s, lambda x: F.transform(p, lambda y: F.concat(x, y)))))


def ambiguities(seq: Column | str) -> Column:
    """Number of sets of alternatives."""
    return F.size(F.filter(parts(seq), lambda p: F.size(p) > 1))


def lengths(seq: Column | str) -> Column:
    """Least and largest length."""
    sizes = lambda pick: F.aggregate(parts(seq), F.lit(0), lambda s, p: s + pick(F.transform(p, lambda x: F.length(x))))
    return F.struct(sizes(F.array_min).alias("least"), sizes(F.array_max).alias("most"))
