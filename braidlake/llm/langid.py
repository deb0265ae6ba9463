"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against it from left to right
into phrases, each the longest match from where the last one ended; a letter that the learned text lacks is a phrase
of its own. A phrase costs the logarithm of the learned length, as many places it may point to, and a letter that is
lacking the logarithm of the alphabet besides: so phrase counts are normalised, and a language doesn't win by
having more text. The language of the least cost wins (ties: the smaller language value).

The automata share an alphabet: every letter of the learned texts, lower-cased, one symbol for other letters and
one for each run of anything else. Their moves lie in double arrays, whose size follows the learned text and not
the alphabet. Texts are cut into segments that walk the arrays in step, in numpy; a segment is then walked again
from the state in which the one before it ends, until it comes upon the path it has taken before. So every whole text
is parsed as if symbol by symbol, however long it is.

Learned from: at most ``chars_per_lang`` characters of at most ``docs_per_lang`` documents a language (of each
its first 4 * chars_per_lang / docs_per_lang characters at most; the smallest hashes). All languages are learned; if
they would have more than ``all_chars`` characters, each has an equal part of these. These bounds hold for learning alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Without anything learned every
text is ``und``. Very long texts are parsed whole. Repeated rows get equal rows, an empty table none. Columns other
than doc_id and text are ignored in prediction, whatever their names.

score: 0.5 + half of the share by which the runner-up costs more than the winner; 1 with one language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RANGE, columns_of, fold, map_pieces, texts_of

UNKNOWN = "und"
SEGMENT = 512
#: Symbols: 0 blank, 1 any letter that no learned text has, then the letters.
FIRST = 2
#: Bases that a state of several moves tries before a new one is taken.
TRIES = 16

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("phrase_chars", T.DoubleType())]
)


@dataclass
class Model:
    """The learned text of each language, in order of the language values."""

    texts: dict[str, str]

    def parser(self) -> "Parser":
        return Parser(self)


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Moves of the suffix automaton of a sequence; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = links[p]
        if p >= 0:
            q = moves[p][c]
            if lengths[p] + 1 == lengths[q]:
                links[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = links[p]
                links[q] = links[new] = twin
        last = new
    return moves


class Table:
    """An automaton as a double array: a state's move by a symbol lies at the sum of both, and names the state.

    States are named by their base, so a step is one look-up. The root isn't laid out, as every step from it begins a
    phrase: ``root`` has its moves, 0 where the learned text lacks the symbol.
    """

    def __init__(self, moves: list[dict[int, int]], size: int):
        order, seen = [0], {0}
        for s in order:  # breadth first, so that the states near the root, where most steps are, lie together
            for c in sorted(moves[s]):
                if (t := moves[s][c]) not in seen:
                    seen.add(t)
                    order.append(t)
        base, low, used = np.zeros(len(moves), np.int64), size + 1, set()
        taken = bytearray(2 * (len(moves) + size + TRIES))
        # states of many moves first; each tries a few bases from the lowest, so that building takes linear time
        for s in sorted(order[1:], key=lambda s: -len(moves[s])):
            own, at = list(moves[s]), low
            while at in used or any(taken[at + c] for c in own):
                at += 1
                if at + size >= len(taken):
                    taken.extend(bytes(len(taken)))
            used.add(at)
            base[s] = at
            for c in own:
                taken[at + c] = 1
            low = max(low, at - TRIES)
            while low in used:
                low += 1
        top = int(base.max(initial=0)) + size + 1
        owner, self.to = np.full(top, -1, np.int32), np.zeros(top, np.int32)
        for s in order[1:]:
            for c, t in moves[s].items():
                owner[base[s] + c], self.to[base[s] + c] = base[s], base[t]
        self.owner, self.root = owner, np.zeros(size, np.int32)
        for c, t in moves[0].items():
            self.root[c] = base[t]

    def step(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them begin a phrase."""
        at = state + symbols
        fresh = self.owner[at] != state
        return np.where(fresh, self.root[symbols], self.to[at]), fresh


class Parser:
    """The tables of all languages and their shared alphabet."""

    def __init__(self, model: Model):
        letters = sorted({c for t in model.texts.values() for c in t.lower() if c.isalpha()})
        own = {c: i for i, c in enumerate(letters, FIRST)}
        self.size = len(own) + FIRST
        self.codes = np.zeros(0x110000, np.int32)
        for at in range(0x110000):
            if (c := chr(at)).isalpha():
                self.codes[at] = own.get(c.lower()[0], 1)
        self.langs = sorted(model.texts)
        learned = [self.symbols(model.texts[lang]) for lang in self.langs]
        self.tables = [Table(automaton(x.tolist()), self.size) for x in learned]
        #: What a phrase costs in each language, and what a letter that a language lacks costs besides.
        self.price, self.lack = np.log([max(2, len(x)) for x in learned]), float(np.log(self.size))

    def symbols(self, text: str) -> np.ndarray:
        codes = self.codes[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])] if len(codes) else codes

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of symbols of each text, and for each language (row) those of its phrases and of lacking symbols."""
        parts = [self.symbols(x) for x in texts]
        lengths = np.array([len(x) for x in parts], np.int64)
        segments = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), segments)
        ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = np.repeat(np.cumsum(lengths) - lengths, segments) + ordinal * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(lengths, segments) - ordinal * SEGMENT)
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # the segment before each, -1 for a text's first
        before = np.where(ordinal > 0, np.concatenate([[-1], place[:-1]]) if len(place) else place, -1)[order]
        begin, size, owner = begin[order], size[order], owner[order]
        flat = np.concatenate([*parts, np.zeros(1, np.int32)]) if parts else np.zeros(1, np.int32)
        active = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # segments longer than the step
        columns = [flat[begin[:n] + t] for t, n in enumerate(active.tolist()) if n]
        whose = np.repeat(np.arange(len(texts)), lengths)
        counts, lacking = np.zeros((2, len(self.tables), len(texts)), np.int64)
        for row, lack, table in zip(counts, lacking, self.tables, strict=True):
            state, count = np.zeros(len(size), np.int32), np.zeros(len(size), np.int64)
            path = []
            for symbols in columns:
                n = len(symbols)
                got, fresh = table.step(state[:n], symbols)
                count[:n] += fresh
                state[:n] = got
                path.append((got, fresh))
            todo = np.flatnonzero(before >= 0)
            while len(todo):
                todo = self.walk_again(table, todo, state[before[todo]], columns, path, size, count, state)
                todo = np.flatnonzero(np.isin(before, todo) & (before >= 0))
            row += np.bincount(owner, count, len(texts)).astype(np.int64)
            lack += np.bincount(whose, table.root[flat[:-1]] == 0, len(texts)).astype(np.int64)
        return lengths, counts, lacking

    @staticmethod
    def walk_again(table: Table, who: np.ndarray, come: np.ndarray, columns: list, path: list, size: np.ndarray, count: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Walk segments from the states they are come upon in, until their old paths; those whose end is another one."""
        ended = []
        for t, symbols in enumerate(columns):
            if not len(who):
                break
            got, fresh = table.step(come, symbols[who])
            old, was = path[t]
            count[who] += fresh.astype(np.int64) - was[who]
            other, last = got != old[who], size[who] == t + 1
            old[who], was[who] = got, fresh
            if last.any():
                state[who[last]] = got[last]
                ended.append(who[last & other])
            on = other & ~last
            who, come = who[on], got[on]
        return np.concatenate(ended) if ended else who[:0]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and characters a phrase of each text."""
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        some = [i for i, x in enumerate(texts) if x and any(map(str.isalpha, x))]
        if not some or not self.langs:
            return out
        lengths, counts, lacking = self.phrases([texts[i] for i in some])
        costs = counts * self.price[:, None] + lacking * self.lack
        best = np.argmin(costs, axis=0)
        for k, i in enumerate(some):
            least, score = costs[best[k], k], 1.0
            if len(self.langs) > 1:
                second = np.partition(costs[:, k], 1)[1]
                score = 0.5 + 0.5 * (second - least) / second
            out[i] = (self.langs[best[k]], float(score), float(lengths[k] / counts[best[k], k]))
        return out


def fit(docs: DataFrame, docs_per_lang: int = 80, chars_per_lang: int = 24_000, all_chars: int = 16_000_000) -> Model:
    """Learn from documents with a non-null lang whose crc32(doc_id as text) mod 5 is not 0."""
    rows = columns_of(docs, doc_id="long", text="string", lang="string")
    marked = rows.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0))
    counts = marked.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return Model({})
    chars = max(1, min(chars_per_lang, all_chars // len(counts)))
    most = max(1, min(docs_per_lang, chars))
    # hashes below a language's bound are expected to give three times the documents wanted
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(RANGE))
    bounds = docs.sparkSession.createDataFrame([(r["lang"], min(RANGE, (3 * most + 20) * RANGE // r["count"])) for r in counts], "lang string, bound long")
    picked = (
        marked.join(F.broadcast(bounds), "lang")
        .where(hashed < F.col("bound"))
        .select("lang", hashed.alias("h"), F.substring("text", 1, 4 * chars // most).alias("text"))
        .orderBy("h", "text")
        .limit(12 * most * len(counts))
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (r.h, r.text or "")):
        own = texts.setdefault(r.lang, [])
        if r.text and len(own) < most and r.text not in own:
            own.append(r.text)
    return Model({lang: "\n".join(own)[:chars] for lang, own in texts.items()})


_PARSERS: dict[int, Parser] = {}


def parser_of(model: Model) -> Parser:
    """A worker builds the automata once for a model, whatever number of tasks it runs."""
    key = hash(tuple(sorted(model.texts.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = model.parser()
    return _PARSERS[key]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and phrase_chars of every whole text."""

    def of(piece: pa.RecordBatch) -> dict:
        found = parser_of(model).predict(texts_of(piece))
        return {"doc_id": piece.column(0), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "phrase_chars": [x[2] for x in found]}

    return map_pieces(columns_of(docs, doc_id="long", text="string"), of, SCHEMA)
