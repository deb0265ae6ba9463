import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from braidlake.llm import langid, queries

MODEL = langid.Model({"en": "the cat sat on the mat and the dog ran to the sea", "de": "der hund und die katze laufen an das meer und den see", "x": "zzz"})


def brute(parser, text, lang):
    """Phrases by searching the learned text for ever longer substrings."""
    symbols, learned = bytes(parser.symbols(text).tolist()), bytes(parser.symbols(MODEL.texts[lang]).tolist())
    n, i = 0, 0
    while i < len(symbols):
        k = 0
        while i + k < len(symbols) and symbols[i : i + k + 1] in learned:
            k += 1
        i, n = i + max(1, k), n + 1
    return n


PARSER = MODEL.parser()


@given(st.lists(st.text(st.sampled_from("thecadn smorwz,É1"), max_size=1500), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_phrases_against_substring_search(texts):
    lengths, counts, lacking = PARSER.phrases(texts)
    for i, text in enumerate(texts):
        symbols = PARSER.symbols(text).tolist()
        assert lengths[i] == len(symbols)
        assert [brute(PARSER, text, lang) for lang in PARSER.langs] == counts[:, i].tolist()
        for k, lang in enumerate(PARSER.langs):
            learned = set(PARSER.symbols(MODEL.texts[lang]).tolist())
            assert lacking[k, i] == sum(s not in learned for s in symbols)


@given(st.lists(st.text(st.sampled_from("thecadn smorwz,É1"), max_size=60), min_size=1, max_size=5), st.integers(1, 7))
@settings(max_examples=100, deadline=None)
def test_segments_join_without_a_seam(texts, segment):
    whole, langid.SEGMENT = langid.SEGMENT, segment
    try:
        _, counts, _ = PARSER.phrases(texts)
    finally:
        langid.SEGMENT = whole
    for i, text in enumerate(texts):
        assert [brute(PARSER, text, lang) for lang in PARSER.langs] == counts[:, i].tolist()


def words_of(rng, n, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n)]


@pytest.mark.parametrize(("shared", "learned"), [(0.5, 4000), (0.5, 6000), (0.0, 1300)])
def test_a_language_with_less_text_isnt_at_a_loss(shared, learned):
    rng = random.Random(learned)
    common, a, b = (words_of(rng, 300, "abdefgiklmnorstu") for _ in range(3))
    text = lambda own, n: " ".join(rng.choice(common if rng.random() < shared else own) for _ in range(n))
    parser = langid.Model({"a": text(a, 6000)[:24_000], "b": text(b, 6000)[:learned]}).parser()
    got = [x[0] for x in parser.predict([text(b, 60) for _ in range(100)] + [text(a, 60) for _ in range(100)])]
    assert got[:100].count("b") >= 97 and got[100:].count("a") >= 97


def test_alphabets_of_thousands_and_many_languages():
    rng = random.Random(8)
    one, two = ([chr(0x4E00 + rng.randrange(6000)) for _ in range(1500)] for _ in range(2))
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    model = {"one": text(one, 8000), "two": text(two, 8000)}
    model |= {f"l{i:03}": " ".join(words_of(random.Random(i), 40, "abcdefghij")) for i in range(80)}
    parser = langid.Model(model).parser()
    assert [x[0] for x in parser.predict([text(one, 200), text(two, 200)])] == ["one", "two"]
    asked = [" ".join(random.Random(i).sample(model[f"l{i:03}"].split(), 20)) for i in range(80)]
    assert [x[0] for x in parser.predict(asked)] == [f"l{i:03}" for i in range(80)]


def test_verdict_against_brute_force():
    texts = ["the dog sat on the sea", "der hund und das meer", "zz the", "catÉÉ"]
    for text, got in zip(texts, PARSER.predict(texts), strict=True):
        costs = []
        for lang in PARSER.langs:
            learned = PARSER.symbols(MODEL.texts[lang]).tolist()
            lack = sum(s not in set(learned) for s in PARSER.symbols(text).tolist())
            costs.append(brute(PARSER, text, lang) * math.log(len(learned)) + lack * math.log(PARSER.size))
        assert got[0] == PARSER.langs[costs.index(min(costs))]


def test_predictions():
    got = PARSER.predict(["the dog sat", "die katze und der hund", "", None, "12 ...", "zzz"])
    assert [x[0] for x in got] == ["en", "de", "und", "und", "und", "x"]
    assert all(0 <= x[1] <= 1 for x in got) and got[2][1] == 0
    assert langid.Model({}).parser().predict(["abc"]) == [("und", 0.0, 0.0)]


def test_awkward_rows(awkward, empty):
    rows = langid.identify(awkward, langid.fit(awkward)).collect()
    assert len(rows) == awkward.count()
    assert {r.lang_pred for r in rows if r.doc_id in (300, 301, 302, 305)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id == 303} == {"en"}
    assert langid.identify(empty, langid.fit(empty)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op7_language_id(spark, sf).collect()}
    docs = [r for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(rows[r.doc_id].held_out for r in docs)
    assert sum(rows[r.doc_id].lang_pred == r.lang for r in docs) >= 0.97 * len(docs)
