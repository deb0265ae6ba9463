"""Chat formatting with a grammar round trip.

A conversation becomes ``<s>`` and, for each turn, ``[INST]role[/INST]text</s>``. A deterministic parser reads
it back: it looks for the next mark and nothing else. A text that holds a mark of its own would be read back
wrongly, so each turn is rendered, parsed and compared, and its conflicting strings are escaped until the parse
gives the source again: a mark ``<s>`` inside a text becomes ``<\\s>``, and what looks like that already gets
one more backslash, which makes the escape reversible.

Turns are handled as a sorted stream, so a conversation of any length needs the memory of one turn.

Defined cases: a null role or text counts as empty. Turns are ordered by turn (null first), then role, then
text; repeated rows are turns of their own. A null conv_id is a conversation like any other. An empty table
gives no row. Columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.runtime import map_arrow

from .common import columns_of, pieces

BEGIN, ROLE, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
MARKS = (BEGIN, ROLE, BODY, END)
#: A mark, with any number of backslashes after its first character.
LIKE_MARK = re.compile("|".join(rf"{re.escape(m[0])}(\\*){re.escape(m[1:])}" for m in MARKS))
ESCAPED = re.compile("|".join(rf"({re.escape(m[0])}\\*)\\({re.escape(m[1:])})" for m in MARKS))

CHUNKS = "conv_id long, turn_index long, chunk string, loss_start long, loss_stop long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return LIKE_MARK.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "".join(x for x in m.groups() if x is not None), text)


class Broken(ValueError):
    """The text isn't of the grammar."""


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """Role, text, where the escaped text starts and stops, and where the next turn may begin."""
    if not text.startswith(ROLE, at):
        raise Broken(f"no turn at {at}")
    if (body := text.find(BODY, at + len(ROLE))) < 0:
        raise Broken(f"no text at {at}")
    start = body + len(BODY)
    if (stop := text.find(END, start)) < 0:
        raise Broken(f"no end at {at}")
    return unescape(text[at + len(ROLE) : body]), unescape(text[start:stop]), start, stop, stop + len(END)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a whole formatted conversation."""
    if not text.startswith(BEGIN):
        raise Broken("no beginning")
    at, turns = len(BEGIN), []
    while at < len(text):
        role, body, _, _, at = parse_turn(text, at)
        turns.append((role, body))
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the place of its text, escaped as often as the round trip asks for."""
    r, t = role, text
    for _ in range(3):
        chunk = f"{ROLE}{r}{BODY}{t}{END}"
        try:
            got_role, got_text, start, stop, after = parse_turn(chunk)
        except Broken:
            got_role, got_text, start, stop, after = None, None, 0, 0, -1
        whole = after == len(chunk)
        if whole and (got_role, got_text) == (role, text) and not has_mark(chunk[start:stop]):
            return chunk, start, stop
        if got_role != role or not whole:
            r = escape(role)
        if got_text != text or not whole or has_mark(t):
            t = escape(text)
    raise AssertionError("escaping is reversible")


def has_mark(text: str) -> bool:
    return any(m in text for m in MARKS)


def ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation in one partition, in order. Only the sort that Spark can spill holds more than a batch."""
    turns = columns_of(conversations, conv_id="long", turn="long", role="string", text="string")
    return turns.fillna("", ["role", "text"]).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """A row for each turn, in order within its partition: the conversation's text is its chunks put together.

    loss_start and loss_stop give the characters of the conversation's text under the loss mask, null for turns
    of other roles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, index, length = object(), 0, 0
        for piece in pieces(batches):
            out = []
            for conv_id, _, role, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                if conv_id != conv:
                    conv, index, length = conv_id, 0, 0
                chunk, start, stop = render_turn(role, text)
                if index == 0:
                    chunk, start, stop = BEGIN + chunk, start + len(BEGIN), stop + len(BEGIN)
                loss = (length + start, length + stop) if role == loss_role else (None, None)
                out.append((conv_id, index, chunk, *loss))
                index, length = index + 1, length + len(chunk)
            yield as_batch(out, CHUNKS)

    return map_arrow(ordered(conversations), run, CHUNKS)


def as_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in ddl.split(", ")), strict=True)
    types = [{"long": pa.int64(), "string": pa.string()}[k] for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)], names=list(names))


def read_back(chunks: DataFrame, in_order: bool = False) -> DataFrame:
    """Parse formatted conversations into one digest row each.

    Only the chunks and the loss spans are read; the source isn't. in_order: the rows lie as format_conversations
    leaves them; otherwise they are sorted first. A turn that is missing or twice there is an error.
    """
    if not in_order:
        chunks = chunks.select("conv_id", "turn_index", "chunk", "loss_start", "loss_stop").repartition("conv_id").sortWithinPartitions("conv_id", "turn_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Digest | None = None
        for piece in pieces(batches, "chunk"):
            out = []
            for conv_id, index, chunk, start, stop in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                if index == 0:
                    out += [state.row()] if state else []
                    state = Digest(conv_id)
                if state is None or (conv_id, index) != (state.conv_id, state.turns):
                    raise Broken(f"turn {index} of conversation {conv_id} is out of order")
                state.add(chunk, start, stop)
            yield as_batch(out, DIGESTS)
        if state:
            yield as_batch([state.row()], DIGESTS)

    return map_arrow(chunks, run, DIGESTS)


class Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, chunk: str, start: int | None, stop: int | None) -> None:
        at = len(BEGIN) if self.turns == 0 else 0
        if self.turns == 0 and not chunk.startswith(BEGIN):
            raise Broken("no beginning")
        role, text, _, _, after = parse_turn(chunk, at)
        if after != len(chunk):
            raise Broken("more than a turn")
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            under = unescape(chunk[start - self.chars : stop - self.chars])
            self.loss_chars += len(under)
            self.loss.update(under.encode())
        self.turns, self.chars = self.turns + 1, self.chars + len(chunk)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def round_trip(conversations: DataFrame) -> DataFrame:
    """Format every conversation and read it back."""
    return read_back(format_conversations(conversations), in_order=True)
