"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.runtime import table

from . import chat, langid, lmscore, mixing, packing, quality, sharding, simhash, topk, toxicity
from .common import fold


def op1_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a sentence model learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "n_toxic_sentences")


#: The conversation that the query adds.
PROBE = "</s>[INST] ok [/INST]"


def op2_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of conversation -1, read back from their formatted texts."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.round_trip(turns.unionByName(probe))


def op3_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition figures and the verdict on every document."""
    return quality.rules(table(spark, sf_dir, "documents"))


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.components(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of each vector whose id is divisible by 50."""
    return topk.search(table(spark, sf_dir, "embeddings"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by automata learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "phrase_chars")


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of near equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """Where the public tokenizer lies on this machine, and alike on the executors."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document, between documents labelled good and all documents."""
    docs = table(spark, sf_dir, "documents")
    return lmscore.score(docs, lmscore.fit(docs, lmscore.target_of(table(spark, sf_dir, "labels"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity_mil,
        op2_chat_round_trip,
        op3_repetition_quality,
        op4_simhash_components,
        op5_exact_topk,
        op6_mix_sources,
        op7_language_id,
        op8_minimax_shards,
        op9_best_fit_pack,
        op10_lm_scoring,
    )
}

#: SQL for the operators that it can express. The others are held against brute force in the tests.
ORACLE_SQL: dict[str, str] = {}

MARK = r"<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]"

ORACLE_SQL["op2_chat_round_trip"] = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (SELECT *, length(role) + length(text) + len(regexp_extract_all(role, '{MARK}')) + len(regexp_extract_all(text, '{MARK}')) + {len(chat.ROLE + chat.BODY + chat.END)} AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + {len(chat.BEGIN)} AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def _shares() -> str:
    """For each n-gram length the characters of words inside windows that their text repeats."""
    parts = [
        f"""g{n} AS (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM docs WHERE len(w) >= {n})),
c{n} AS (SELECT doc_id, count(*) AS words, sum(length(w[p])) AS chars FROM (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM g{n}) WHERE k > 1)
  JOIN docs USING (doc_id) GROUP BY 1)"""
        for n in sorted({quality.BASE_N, *quality.LIMITS})
    ]
    return ",\n".join(parts)


WORD = r"[^\x20\x09-\x0D]"

ORACLE_SQL["op3_repetition_quality"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w FROM documents),
lines AS (SELECT doc_id, line, CAST(coalesce(list_sum(list_transform(regexp_extract_all(line, '{WORD}+'), lambda x: length(x))), 0) AS BIGINT) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{WORD}')),
kinds AS (SELECT doc_id, line, any_value(chars) AS chars, count(*) AS n FROM lines GROUP BY 1, 2),
dups AS (SELECT doc_id, sum(n - 1) AS n, sum((n - 1) * chars) AS chars FROM kinds GROUP BY 1),
{_shares()},
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c3.words, 0) AS BIGINT) AS n_repeat_words,
  coalesce(dups.chars, 0) AS line_chars, {", ".join(f"coalesce(c{n}.chars, 0) AS chars{n}" for n in quality.LIMITS)}
  FROM docs LEFT JOIN dups USING (doc_id) {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in sorted({quality.BASE_N, *quality.LIMITS}))}),
shares AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  CAST(line_chars AS DOUBLE) / greatest(1, word_chars) AS dup_line_share, {", ".join(f"CAST(chars{n} AS DOUBLE) / greatest(1, word_chars) AS dup_{n}gram_share" for n in quality.LIMITS)} FROM base)
SELECT *, NOT base_failed AND dup_line_share <= {quality.LINE_LIMIT} {" ".join(f"AND dup_{n}gram_share <= {m}" for n, m in quality.LIMITS.items())} AS kept FROM shares"""

ORACLE_SQL["op5_exact_topk"] = f"""
WITH vecs AS (SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id WHERE q.vec_id % {topk.EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM ranked WHERE place <= {topk.K}"""
