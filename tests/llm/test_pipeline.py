from collections import Counter

import pytest

import corpus_pipeline
from braidlake.llm import langid, mixing, toxicity

from .conftest import brute_words
from .test_nearcopies import brute_components, brute_print
from .test_packing import check as check_packing

STAGES = dict(corpus_pipeline.STAGES)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "mix_sources", "best_fit_pack"]


@pytest.fixture(scope="module")
def stages(spark, documents, sf, tmp_path_factory):
    """Every stage's input and output, written and read again."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_language_stage(stages, documents):
    before, after = stages["language_id"]
    parser = langid.fit(before).parser()
    kept = [r.doc_id for r in before.collect() if (x := parser.predict([r.text])[0])[0] != "und" and x[2] >= corpus_pipeline.MIN_PHRASE_CHARS]
    assert ids(after) == sorted(kept) and after.columns == documents.columns
    assert len(kept) >= 0.98 * before.count()


def test_toxicity_stage(spark, stages, sf, documents):
    before, after = stages["toxicity"]
    scorer = toxicity.fit(before, spark.read.parquet(f"{sf}/labels.parquet")).scorer()
    assert ids(after) == sorted(r.doc_id for r in before.collect() if scorer.document(r.text) < 0.5)
    assert after.columns == documents.columns


def test_near_dedup_stage(stages, documents):
    before, after = stages["near_dedup"]
    want = brute_components([(r.doc_id, brute_print(r.text)) for r in before.collect()])
    assert ids(after) == sorted(set(want)) and after.columns == documents.columns


def test_mix_stage(stages, documents):
    before, after = stages["mix_sources"]
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix(before).collect()}
    got = Counter(r.doc_id for r in after.collect())
    for r in before.collect():
        if brute_words(r.text):
            assert got[r.doc_id] == taken[r.doc_id]
    assert after.columns == documents.columns


def test_pack_stage(stages):
    from tokenizers import Tokenizer

    from braidlake.llm.queries import tokenizer_path

    before, after = stages["best_fit_pack"]
    check_packing(before, after.collect(), Tokenizer.from_file(tokenizer_path()))


def test_run_is_the_stages_in_turn(spark, sf, stages):
    want = sorted(tuple(r)[:5] for r in stages["best_fit_pack"][1].collect())
    assert sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_awkward_input(spark, awkward, sf):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == awkward.columns, name
    last = STAGES["best_fit_pack"](spark, docs, sf)
    assert last.count() >= docs.count() > 0
    nothing = awkward.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, sf)
    assert nothing.count() == 0
