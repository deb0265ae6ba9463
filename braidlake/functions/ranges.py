"""Arguments that name sets of numbers: ``{1,4,[7,9]}``, single values, and ranges."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM = re.compile(r"\[\s*(-?\d+)\s*,\s*(-?\d+)\s*\]|(-?\d+(?:\.\d+)?)|([^\s,{}\[\]]+)")


def parse_set(text: str) -> list[int | float | str]:
    """The members, in order, each once. ``[a,b]`` stands for all whole numbers from a to b."""
    out: list[int | float | str] = []
    for low, high, number, word in ITEM.findall(text):
        if low:
            out += range(int(low), int(high) + 1)
        elif number:
            out.append(float(number) if "." in number else int(number))
        else:
            out.append(word)
    return list(dict.fromkeys(out))


def member(column: Column, text: str) -> Column:
    """Whether a column's value is in the set."""
    return column.isin(*parse_set(text)) if parse_set(text) else F.lit(False)
