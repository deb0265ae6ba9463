"""Quality rules on repetition.

Base rules: at least 50 words; at most half of the words in 3-word windows that the text repeats.

Repetition coverage: polynomial rolling hashes of the words, for several n-gram lengths, over all texts of a
batch at once in numpy. A window is duplicated if its hash occurs twice or more in its text; the share of the
words' characters inside duplicated windows must stay within the length's limit, and so must the share inside
lines that equal an earlier one.

Defined cases: a null or empty text has no words and fails the base rule. Lines without a word don't count.
Repeated rows get equal rows, an empty table none. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_pieces, texts_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
BASE_N = 3
#: n-gram length -> largest share of characters inside duplicated n-grams
LIMITS = {5: 0.30, 7: 0.27, 10: 0.25}
LINE_LIMIT = 0.20

RADIX = np.uint64(0x9E3779B97F4A7C15)
#: Keeps texts apart: windows of different texts never count as copies of each other.
APART = np.uint64(0xD6E8FEB86659FD93)

SCHEMA = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("dup_line_share", T.DoubleType())]
    + [T.StructField(f"dup_{n}gram_share", T.DoubleType()) for n in LIMITS]
)


def covered(hashes: np.ndarray, owner: np.ndarray, n: int, rolled: np.ndarray) -> np.ndarray:
    """Which words lie in an n-word window that its text holds twice or more. rolled: hashes of the windows."""
    inside = np.zeros(len(hashes) + 1, np.int32)
    whole = np.flatnonzero(owner[: len(rolled)] == owner[n - 1 :]) if len(rolled) else np.empty(0, np.int64)
    keys = rolled[whole] ^ (owner[whole].astype(np.uint64) * APART)
    keys = (keys ^ (keys >> np.uint64(29))) * RADIX
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if len(twice):
        at = whole[twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys]
        np.add.at(inside, at, 1)
        np.add.at(inside, at + n, -1)
    return np.cumsum(inside[:-1]) > 0


def measure(texts: list[str | None]) -> dict:
    """The columns of SCHEMA but doc_id for some texts."""
    count = len(texts)
    words: list[bytes] = []
    n_words = np.zeros(count, np.int64)
    out = {c: [0] * count for c in ("word_chars", "n_symbols", "n_dup_lines")}
    lines_share = [0.0] * count
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode()
        own = raw.split()
        words += own
        n_words[i] = len(own)
        out["word_chars"][i] = len(text) - len(raw) + sum(map(len, own))
        out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        kinds = set(lines)
        if len(kinds) < len(lines):
            out["n_dup_lines"][i] = len(lines) - len(kinds)
            size = lambda x: len(b"".join(x.split()).decode(errors="replace"))
            lines_share[i] = (sum(map(size, lines)) - sum(map(size, kinds))) / max(1, out["word_chars"][i])
    out["n_words"] = n_words
    out["dup_line_share"] = lines_share
    owner = np.repeat(np.arange(count, dtype=np.int64), n_words)
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    joined = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    later = np.concatenate([[0], np.cumsum((joined & 0xC0) == 0x80)])  # bytes that continue a character
    chars = sizes - (later[ends] - later[ends - sizes])
    rolled, n_rolled = hashes, 1
    for n in sorted({BASE_N, *LIMITS}):
        while n_rolled < n:
            rolled = rolled[:-1] * RADIX + hashes[n_rolled:] if len(rolled) else rolled
            n_rolled += 1
        mask = covered(hashes, owner, n, rolled)
        if n == BASE_N:
            out["n_repeat_words"] = np.bincount(owner[mask], minlength=count)
        if n in LIMITS:
            out[f"dup_{n}gram_share"] = np.bincount(owner[mask], chars[mask], count) / np.maximum(1, out["word_chars"])
    failed = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * n_words)
    fine = np.array(lines_share) <= LINE_LIMIT
    for n, most in LIMITS.items():
        fine &= out[f"dup_{n}gram_share"] <= most
    return out | {"base_failed": failed, "kept": ~failed & fine}


def rules(docs: DataFrame) -> DataFrame:
    """The figures of every text and whether it is kept."""
    return map_pieces(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        lambda piece: {"doc_id": piece.column(0)} | measure(texts_of(piece)),
        SCHEMA,
    )
