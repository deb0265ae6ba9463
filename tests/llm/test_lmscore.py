import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from braidlake.llm import lmscore
from braidlake.llm.common import fold

GOOD = ["the cat sat on the mat", "the dog sat on the mat", "the cat ran on the mat"]
OTHER = ["buy now cheap cheap deal", "buy cheap now deal deal", "deal now buy cheap"]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def brute(texts, target, text):
    """Both cross-entropies with exact counts; the vocabulary is the words that occur twice."""
    vocabulary = {w for w, n in Counter(w for t in texts for w in t.split()).items() if n >= 2}
    fold = lambda t: ["<>", *[w if w in vocabulary else "<?>" for w in t.split()], "<>"]
    out = []
    for part in (target, texts):
        words, pairs, before = Counter(), Counter(), Counter()
        for t in part:
            f = fold(t)
            words.update(f[1:])
            before.update(f[:-1])
            pairs.update(zip(f, f[1:], strict=False))
        total, size = sum(words.values()), len(vocabulary) + 2
        loss = 0.0
        f = fold(text)
        for a, b in zip(f, f[1:], strict=False):
            p = (words[b] + 0.5) / (total + 0.5 * size)
            loss -= math.log((pairs[a, b] + lmscore.M * p) / (before[a] + lmscore.M))
        out.append(loss / (len(f) - 1))
    return out


def test_against_exact_counts(spark):
    texts = GOOD + OTHER
    df = docs_of(spark, texts)
    model = lmscore.fit(df, frozenset({0, 1, 2}))
    for r in lmscore.score(df, model).collect():
        target, background = brute(texts, GOOD, texts[r.doc_id])
        assert abs(r.ce_target - target) < 1e-4 and abs(r.ce_background - background) < 1e-4
        assert abs(r.score - (r.ce_target - r.ce_background)) < 1e-12
        assert r.n_tokens == len(texts[r.doc_id].split())
        assert (r.score < 0) == (r.doc_id < 3)


def test_vocabulary_takes_equal_counts_together(spark):
    df = docs_of(spark, ["a a a b b c c d", "A e"])
    assert lmscore.vocabulary(df, 10) == [b"a", b"b", b"c"]
    assert lmscore.vocabulary(df, 2) == [b"a"]
    assert lmscore.vocabulary(df, 0) == []


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, 0), (2, None), (1, 1)], "doc_id long, quality int")
    target = lmscore.target_ids(labels)
    assert target == {1}
    rows = lmscore.score(awkward, lmscore.fit(awkward, target)).collect()
    assert len(rows) == awkward.count() and all(np.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (300, 301, 302)} == {0}
    assert lmscore.score(empty, lmscore.fit(empty, frozenset())).count() == 0
    same = lmscore.score(awkward, lmscore.fit(awkward, frozenset())).collect()
    assert all(r.score == 0 for r in same)


def test_held_out_good_documents_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = lmscore.target_ids(labels.where(fold(F.col("doc_id")) != 0))
    scores = {r.doc_id: r.score for r in lmscore.score(docs, lmscore.fit(docs, learned)).collect()}
    held = labels.where(fold(F.col("doc_id")) == 0).collect()
    good = [scores[r.doc_id] for r in held if r.quality == 1]
    bad = [scores[r.doc_id] for r in held if r.quality == 0]
    ranked = sum((g < b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ranked >= 0.9, ranked


def test_every_word_and_bigram_keeps_its_own_count(spark):
    """More words than 60,000 of one count and more bigrams than 2^19 cells, against exact counts."""
    words = [f"w{i}" for i in range(70_000)]
    texts = [" ".join(words[i] for i in range(k, 70_000 * 9 + k, 9 + k) if i < 70_000) for k in range(9)] + [" ".join(words[::-1]), " ".join(words)]
    texts += [" ".join(words[(i * step) % 70_000] for i in range(70_000)) for step in (3, 11, 13, 17, 19, 23, 27, 29)]
    df = docs_of(spark, texts)
    rows = {r.doc_id: r for r in lmscore.score(df, lmscore.fit(df, frozenset({0, 1, 9, 11}))).collect()}
    assert len(rows) == len(texts)
    for k in (0, 5, 9, 10, 14):
        target, background = brute(texts, [texts[i] for i in (0, 1, 9, 11)], texts[k])
        assert abs(rows[k].ce_target - target) < 1e-6 and abs(rows[k].ce_background - background) < 1e-6


def test_other_documents_than_the_corpus(spark):
    texts = GOOD + OTHER
    model = lmscore.fit(docs_of(spark, texts), frozenset({0, 1, 2}))
    others = ["the cat sat now", "unseen words", "cheap cheap mat"]
    for r in lmscore.score(docs_of(spark, others), model).collect():
        target, background = brute(texts, GOOD, others[r.doc_id])
        assert abs(r.ce_target - target) < 1e-9 and abs(r.ce_background - background) < 1e-9


def test_all_documents_labelled_good_are_counted(spark, tmp_path):
    """More than 20,000, which the query once took at most."""
    from braidlake.llm.queries import op10_lm_scoring

    n = 20_500
    docs = spark.range(n + 2).selectExpr("id as doc_id", f"case when id < {n} then concat('w', id, ' w', id) else 'other other' end as text")
    docs.unionByName(docs.where(f"doc_id = {n}").withColumn("doc_id", F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(n).selectExpr("id as doc_id", "1 as quality").unionByName(spark.sql("select cast(null as bigint) as doc_id, 1 as quality")).write.parquet(f"{tmp_path}/labels.parquet")
    rows = op10_lm_scoring(spark, str(tmp_path)).collect()
    # every good text is as like the target as any other, those not labelled are unlike
    good = {round(r.score, 9) for r in rows if r.doc_id is not None and r.doc_id < n}
    assert len(rows) == n + 3 and len(good) == 1 and max(good) < 0
    assert all(r.score > 0 for r in rows if r.doc_id is None or r.doc_id >= n)


def test_labels_too_many_to_broadcast(spark, monkeypatch):
    from braidlake.operators import joins

    monkeypatch.setattr(joins, "SMALL_SIDE", 1)
    texts = GOOD + OTHER
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    df = docs_of(spark, texts)
    for r in lmscore.score(df, lmscore.fit(df, lmscore.target_of(labels))).collect():
        target, background = brute(texts, GOOD, texts[r.doc_id])
        assert abs(r.ce_target - target) < 1e-9 and abs(r.ce_background - background) < 1e-9
