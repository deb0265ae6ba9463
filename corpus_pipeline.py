"""A corpus pipeline over documents: language, toxicity, near duplicates, mixing, packing.

Each stage works on all its predecessor kept. All but the last return the columns of documents, and keep extra
columns as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from braidlake.llm import langid, mixing, nearcopies, packing, toxicity
from braidlake.llm.common import filter_pieces, texts_of
from braidlake.llm.queries import tokenizer_path
from braidlake.runtime import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose text no learned language explains better than this many characters a phrase is rejected.
MIN_PHRASE_CHARS = 1.8
#: A document with at least this probability of being toxic is rejected.
MAX_TOXICITY = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without a letter or of no language go."""
    model = langid.fit(docs)

    def keep(piece) -> list[bool]:
        found = langid.parser_of(model).predict(texts_of(piece))
        return [lang != langid.UNKNOWN and chars >= MIN_PHRASE_CHARS for lang, _, chars in found]

    return filter_pieces(docs, keep)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels, doesn't find toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = []

    def keep(piece) -> list[bool]:
        if not held:
            held.append(model.scorer())
        return [held[0].document(x) < MAX_TOXICITY for x in texts_of(piece)]

    return filter_pieces(docs, keep)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: all of a five-word similarity of 0.8 or more, and what SimHash links."""
    return nearcopies.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply(docs)


def best_fit_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_pack", best_fit_pack),
]

#: No SQL has these stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
