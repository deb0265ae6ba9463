import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from braidlake.llm import packing, queries

PATH = queries.tokenizer_path()


def brute_rooms(lengths, capacity):
    """What best-fit decreasing leaves free in each sequence, piece by piece."""
    rooms, count = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, count = capacity, count + 1
        bisect.insort(rooms, room - n)
    return rooms, count


@given(st.lists(st.integers(1, 30), max_size=120))
@settings(max_examples=200, deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    plan = packing.plan(dict(Counter(lengths)), 30)
    filled = defaultdict(dict)
    for length, moves in plan.items():
        total = Counter(lengths)[length]
        firsts = [m[0] for m in moves] + [total]
        for (first, each, sequence, offset), end in zip(moves, firsts[1:], strict=True):
            for rank in range(first, end):
                which, place = divmod(rank - first, each)
                at = offset + place * length
                assert at not in filled[sequence + which]
                filled[sequence + which][at] = length
    for parts in filled.values():
        at = 0
        for offset in sorted(parts):
            assert offset == at
            at += parts[offset]
        assert at <= 30
    rooms, count = brute_rooms(lengths, 30)
    assert len(filled) == count
    assert sorted(30 - sum(p.values()) for p in filled.values()) == rooms


def test_least_room():
    rng = random.Random(1)
    rooms, there = packing.Rooms(100), set()
    for _ in range(500):
        x = rng.randint(0, 100)
        rooms.set(x, x not in there)
        there ^= {x}
        y = rng.randint(0, 100)
        assert rooms.least(y) == min((r for r in there if r >= y), default=None)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@given(st.text(st.sampled_from("abÉé's.,!?<|>12~ \n\t\x1c\x85 ΣςİßǺ中"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_of_words_are_those_of_the_text(text):
    words, whole = packing.words_of(PATH), packing.words_of(PATH).tokenizer
    assert words.ids([text])[0] == np.array(whole.encode(text, add_special_tokens=False).ids + [0], "<u4").tobytes()


def check(df, rows, tokenizer):
    want = []
    for r in df.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((r.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == brute_rooms([w[3] for w in want], 2048)[1]


def test_query_against_brute_force(documents, awkward, empty, tokenizer):
    for df in (documents, awkward):
        check(df, packing.pack(df, PATH).collect(), tokenizer)
    assert packing.pack(empty, PATH).count() == 0
