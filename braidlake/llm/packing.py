"""Best-fit packing of token sequences.

A document's ids are those of a public tokenizer and then id 0. Longer documents are cut into pieces of
``CAPACITY`` ids, of which the last may be shorter. Best-fit decreasing takes the pieces from long to short and
puts each into the open sequence with the least room that still holds it; a segment tree over remaining
capacities finds that room in logarithmic time.

Pieces of one length are interchangeable, and so are sequences with the same room. So the packing is planned
from the histogram of lengths (at most CAPACITY numbers, counted over all documents): a move puts a range of the
pieces of one length, by rank, into a range of sequences. The plan is as small for any number of documents, and
is the packing that best-fit decreasing makes piece by piece. Each piece then finds its rank among the pieces of
its length, counted apart in each partition, and its place in the plan. Full pieces fill a sequence each and need no rank.

Tokens are looked up by word: the tokenizer's pre-tokenizer never joins across white space, so the ids of a text
are those of its words. Words are cached in bounded memory. Texts with the control characters 0x1C-0x1F, where
definitions of white space differ, are tokenized whole.

Defined cases: a null or empty text is the single id 0. Repeated rows are packed each. An empty table gives an
empty result. Very long texts are cut into as many pieces as it takes. Columns other than doc_id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.runtime import map_arrow, materialize

from .common import columns_of, pieces, ranked, texts_of

CAPACITY = 2048
#: What ends a document: id 0.
END = bytes(4)
#: Words of a generation that a worker remembers; long ones count for more.
CACHE = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def byte_letters() -> str:
    """The character that a byte-level pre-tokenizer shows for each byte: its own if printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


class Words(dict):
    """The ids of words (bytes), as little-endian 32-bit bytes, filled as words are met.

    Two generations of words are remembered: when the younger is full it becomes the older, and words of the older
    that are met again move to the younger. Of a plain word (letters below U+0250, which no normalizer joins, and
    then ASCII punctuation) the pre-tokenizer makes two, so its letters are looked up apart, in lower case.
    """

    ODD = re.compile("[\x1c-\x1f]")
    #: All letters below U+0250 but U+0130, whose lower case is two characters.
    PLAIN = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.old_parts: dict[bytes, bytes] = {}
        self.size = 0

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def core(self, letters: bytes) -> bytes:
        """The ids of letters in lower case, straight from the model."""
        shown = letters.decode("latin-1")
        ids = [t.id for t in self.model.tokenize(shown if letters.isascii() else "".join(map(self.letters.__getitem__, letters)))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.old.get(word)) is None:
            letters = word.rstrip(b".,;:!?")
            tail = word[len(letters) :]
            if letters.isalpha():  # ASCII letters only
                letters = letters.lower()
            elif match := self.PLAIN.fullmatch(word.decode()):
                letters, tail = match[1].lower().encode(), match[2].encode()
            else:
                letters = b""
            if letters:
                if (ids := self.parts.get(letters)) is None:
                    ids = self.parts[letters] = self.old_parts.get(letters) or self.core(letters)
                if tail:
                    if (end := self.parts.get(tail)) is None:
                        end = self.parts[tail] = self.encode(tail.decode())
                    ids += end
            else:
                ids = self.encode(word.decode())
        self[word] = ids
        self.size += 1 + len(word) // 64
        return ids

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, and id 0 after them."""
        out, get = [], self.__getitem__
        for text in texts:
            if text and self.ODD.search(text):
                out.append(self.encode(text) + END)
                continue
            out.append(b"".join(map(get, text.encode().split())) + END if text else END)
            if self.size > CACHE:
                self.old = dict(self)
                self.clear()
                self.old_parts, self.parts, self.size = self.parts, {}, 0
        return out


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document. tokenizer: the path of its file, on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        for piece in pieces(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(piece.column(0).to_pylist(), words.ids(texts_of(piece)), strict=True):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(columns_of(docs, doc_id="long", text="string"), run, PIECES)


class Rooms:
    """A segment tree over remaining capacities: which have an open sequence, and the least that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.leaves)

    def set(self, room: int, there: bool) -> None:
        at = self.leaves + room
        self.some[at] = there
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def least(self, room: int) -> int | None:
        """The least remaining capacity of at least ``room`` that an open sequence has."""
        at = self.leaves + room
        if self.some[at]:
            return room
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """Best-fit decreasing over lengths and their counts.

    For each length its moves, by rank: (first rank, pieces a sequence, first sequence, offset of the first
    piece). Rank r of a move goes to sequence first + (r - first rank) // pieces, after the pieces before it.
    """
    moves: dict[int, list[tuple[int, int, int, int]]] = {}
    rooms, opened = Rooms(capacity), 0
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> ranges of sequences with it

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            open_.setdefault(room, []).append((first, count))
            rooms.set(room, True)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, rank, own = histogram[length], 0, moves.setdefault(length, [])
        while left:
            room = rooms.least(length)
            if room is None:
                # no sequence has room: open as many as are needed, each filled before the next
                room, each = capacity, capacity // length
                first, count = opened, -(-left // each)
                opened += count
            else:
                first, count = open_[room].pop()
                if not open_[room]:
                    rooms.set(room, False)
                each = room // length
            # a sequence that takes a piece has the least room thereafter, so it takes all it can
            full, rest = divmod(min(left, each * count), each)
            own.append((rank, each, first, capacity - room))
            if full:
                leave(room - each * length, first, full)
            if rest:
                leave(room - rest * length, first + full, 1)
            leave(room, first + full + (rest > 0), count - full - (rest > 0))
            rank, left = rank + each * full + rest, left - each * full - rest
    return moves


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    found = materialize(cut(docs, tokenizer, capacity).withColumn("mid", F.monotonically_increasing_id()), "pieces")
    names = PLACED.replace(",", "").split()[::2]
    # a full piece is a sequence; the others' are numbered from 0 on
    full = found.where(F.col("length") == capacity).select(*names[:5], (-1 - F.col("mid")).alias(names[5]), F.lit(0).cast("long").alias(names[6]))
    rest = found.where(F.col("length") < capacity)
    # one row a length
    moves = plan({r.length: r["count"] for r in rest.groupBy("length").count().collect()}, capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {x: np.array(m, np.int64) for x, m in moves.items()}
        for batch in batches:
            lengths, ranks = (np.asarray(batch.column(i)).astype(np.int64) for i in (3, 5))
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            kinds, begin = np.unique(lengths[order], return_index=True)
            for length, at in zip(kinds.tolist(), np.split(order, begin[1:]), strict=True):
                table, rank = tables[length], ranks[at]
                move = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                which, place = np.divmod(rank - move[:, 0], move[:, 1])
                sequence[at], offset[at] = move[:, 2] + which, move[:, 3] + place * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    return map_arrow(ranked(rest, "length").select(*names[:5], "rank"), run, PLACED).unionByName(full)
