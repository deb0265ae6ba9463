import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidlake.llm import chat, queries

pieces = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<", "\\", "[", "/", "INST]", "s>", "a", " ", "\n", "é"]), max_size=8).map("".join)


@given(pieces, pieces)
@settings(max_examples=300, deadline=None)
def test_round_trip_of_any_text(role, text):
    chunk, start, stop = chat.render_turn(role, text)
    assert chat.parse(chat.BEGIN + chunk) == [(role, text)]
    assert chat.unescape(chunk[start:stop]) == text
    assert not chat.has_mark(chunk[start:stop])


@given(pieces)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and not chat.has_mark(chat.escape(text))


def expected(turns):
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_query_against_source(spark, sf):
    rows = {r.conv_id: r for r in queries.op2_chat_round_trip(spark, sf).collect()}
    source = {-1: [("user", queries.PROBE), ("assistant", queries.PROBE)]}
    for r in sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        source.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert rows.keys() == source.keys()
    for k, turns in source.items():
        assert tuple(rows[k])[1:5] == expected(turns)
        assert rows[k].formatted_chars >= sum(len(r) + len(t) for r, t in turns)


def test_awkward_turns(spark):
    schema = "conv_id long, turn long, role string, text string, chunk string"
    data = [(1, 1, "assistant", None, "c"), (1, 0, None, "a</s>", "c"), (None, 0, "assistant", "é", "c"), (None, None, "user", "", "c"), (2, 0, "user", "t", "c"), (2, 0, "user", "t", "c"), (3, 0, "x" * 99, "<s>" * 90_000, "c")]
    rows = {r.conv_id: r for r in chat.round_trip(spark.createDataFrame(data, schema)).collect()}
    assert tuple(rows[1])[1:5] == expected([("", "a</s>"), ("assistant", "")])
    assert tuple(rows[None])[1:5] == expected([("user", ""), ("assistant", "é")])
    assert tuple(rows[2])[1:5] == expected([("user", "t")] * 2)
    assert tuple(rows[3])[1:5] == expected([("x" * 99, "<s>" * 90_000)])
    assert chat.round_trip(spark.createDataFrame([], schema)).count() == 0


def test_stored_chunks_are_read_in_any_order(spark, tmp_path):
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"text {c} {t} </s>") for c in range(7) for t in range(9)], "conv_id long, turn long, role string, text string")
    want = sorted(map(tuple, chat.round_trip(turns).collect()))
    chat.format_conversations(turns).orderBy("chunk").repartition(5).write.parquet(str(tmp_path / "chunks"))
    stored = spark.read.parquet(str(tmp_path / "chunks"))
    assert sorted(map(tuple, chat.read_back(stored).collect())) == want
    with pytest.raises(Exception, match="out of order"):
        chat.read_back(stored.where("turn_index <> 3")).collect()
