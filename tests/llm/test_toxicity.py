import math
import zlib

from braidlake.llm import queries, toxicity

BAD = toxicity.Model({"=vile": 12.0, "vile": 0.0}, -9.0)


def test_noisy_or_combines_sentences():
    scorer = BAD.scorer()
    p = 1 / (1 + math.exp(-3.0))
    q = 1 / (1 + math.exp(9.0))
    assert math.isclose(scorer.document("All is well. This is vile! So vile."), 1 - (1 - p) ** 2 * (1 - q), rel_tol=1e-9)
    assert scorer.document("") == scorer.document(None) == scorer.document(" .!\n") == 0.0


def test_trained_from_document_labels_alone():
    good = [f"the {w} is fine. it was {w} again." for w in ("sky", "sea", "sun", "day", "hill", "tree")] * 6
    bad = [f"the {w} is fine. you utter wretch {w}." for w in ("sky", "sea", "sun", "day", "hill", "tree")] * 6
    model = toxicity.train(good + bad, [0] * len(good) + [1] * len(bad))
    scorer = model.scorer()
    assert scorer.document("the moon is new. you wretch.") >= 0.5 > scorer.document("the moon is new. it was day again.")
    assert toxicity.train(good, [0] * len(good)).weights == {}


def test_locates_sentences(spark):
    docs = spark.createDataFrame([(1, "Fine here. A vile word!\nOk"), (2, None), (3, "")], "doc_id long, text string")
    rows = toxicity.locate(docs, BAD).collect()
    assert [(r.doc_id, r.sentence) for r in rows] == [(1, " A vile word")]
    assert "Fine here. A vile word!\nOk"[rows[0].start : rows[0].stop] == " A vile word"


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(awkward, labels)
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert [r.score for r in rows if r.doc_id in (300, 301, 302)] == [0.0] * 3
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op1_toxicity_mil(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [x for x in labels if zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert all(rows[x.doc_id].held_out for x in held)
    assert sum(rows[x.doc_id].predicted == x.toxic for x in held) >= 0.96 * len(held)
    clean = [x for x in held if not x.toxic]
    assert sum(rows[x.doc_id].predicted for x in clean) <= 0.02 * len(clean)
