import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from braidlake.llm import quality

from .conftest import brute_words


def brute(text):
    text, words = text or "", brute_words(text)
    lines = [x for x in text.split("\n") if brute_words(x)]
    seen, dup_lines, dup_chars = set(), 0, 0
    for x in lines:
        if x in seen:
            dup_lines += 1
            dup_chars += sum(map(len, brute_words(x)))
        seen.add(x)

    def inside(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    chars = sum(map(len, words))
    shares = {n: sum(len(words[i]) for i in inside(n)) / max(1, chars) for n in quality.LIMITS}
    failed = len(words) < 50 or 100 * len(inside(3)) > 50 * len(words)
    kept = not failed and dup_chars / max(1, chars) <= quality.LINE_LIMIT and all(shares[n] <= m for n, m in quality.LIMITS.items())
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup_lines, len(inside(3)), failed, kept), shares


def rows_of(texts):
    got = quality.measure(texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return [(tuple(got[c][i].item() if hasattr(got[c][i], "item") else got[c][i] for c in names), {n: got[f"dup_{n}gram_share"][i] for n in quality.LIMITS}) for i in range(len(texts))]


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "bé", "c#", "\n", "dd", " ", "x y"]), max_size=120).map(" ".join)), max_size=6))
@settings(max_examples=120, deadline=None)
def test_any_texts_against_brute_force(texts):
    for (got, shares), text in zip(rows_of(texts), texts, strict=True):
        want, want_shares = brute(text)
        assert got == want
        assert all(abs(shares[n] - want_shares[n]) < 1e-9 for n in shares)


def test_query_against_brute_force(spark, documents, awkward, empty):
    for df in (documents, awkward):
        texts = sorted(((r.doc_id is None, r.doc_id, r.text or "") for r in df.collect()), key=repr)
        rows = sorted((tuple(r)[:8] for r in quality.rules(df).collect()), key=repr)
        assert rows == sorted(((i, *brute(t)[0]) for _, i, t in texts), key=repr)
    assert quality.rules(empty).count() == 0


def test_repetition_goes_and_clean_text_stays():
    clean = " ".join(f"w{i}" for i in range(200))
    stuck = "\n".join(["one line of five words"] * 40)
    assert [r[0][-1] for r in rows_of([clean, stuck, clean + "\n" + clean])] == [True, False, False]
