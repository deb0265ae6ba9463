"""Toxicity by multiple-instance learning.

A text is a bag of sentences (runs between ``.``, ``!``, ``?`` and line ends). A logistic model gives each
sentence a probability, and noisy-or combines them: a text is toxic unless all its sentences are clean. Only
labels of whole documents train the sentence model; it can then point at the offending sentences.

Learned from: at most ``max_per_class`` documents a class (the smallest hashes of their ids), of at most
``max_chars`` characters each. Both bounds hold for learning alone; every whole text is scored.

Defined cases: a null, empty or wordless text has no sentence and scores 0. Rows are scored one by one, so
repeated rows score alike and an empty table gives an empty result. Columns other than the id and the text
are ignored. Without labels of both classes every sentence has the base probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.runtime import map_arrow, materialize

from .common import few_ids, fold, map_pieces, pieces, texts_of

ENDS = re.compile(r"[.!?\n]+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
#: Of a word, these many first letters are features beside the whole word.
PREFIXES = (4, 5, 6, 7, 8)
#: The base rate of a sentence stays below this logit, so that thousands of clean sentences stay clean.
BASE_LOGIT = -9.0


def features(token: str) -> list[str]:
    """The features of one token: the folded word and its first letters."""
    word = EDGES.sub("", token).lower()
    if len(word) < 3:
        return []
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    """Weights of features, added up for a token and then for a sentence."""

    weights: dict[str, float] = field(default_factory=dict)
    base: float = BASE_LOGIT

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer(dict):
    """Token -> weight, filled as tokens are met; emptied when it has grown to ``LIMIT``."""

    LIMIT = 150_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        get = self.model.weights.get
        weight = sum(get(f, 0.0) for f in features(token))
        if len(token) <= 64:
            self[token] = weight
        return weight

    def sentences(self, text: str | None) -> list[float]:
        """A logit for each sentence that has a token."""
        weight, base = self.__getitem__, self.model.base
        return [base + sum(map(weight, tokens)) for s in ENDS.split(text or "") if (tokens := s.split())]

    def document(self, text: str | None) -> float:
        """Noisy-or of the sentences' probabilities."""
        if not text:
            return 0.0
        clean = 0.0
        for z in self.sentences(text):
            clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
        return min(1.0, max(0.0, -math.expm1(clean)))


def chosen(docs: list[list[np.ndarray]], tokens: list[str], labels: list[int], least: float, most: int) -> dict[str, int]:
    """Features that stand out in toxic documents, by the log-likelihood ratio of document counts.

    docs: the token numbers of each document's sentences. Features are counted by hash, in flat arrays; only those
    chosen are kept as strings.
    """
    flat, stops = [], np.zeros(len(tokens) + 1, np.int64)
    for t, token in enumerate(tokens):
        flat += map(hash, features(token))
        stops[t + 1] = len(flat)
    hashes = np.array(flat, np.int64)
    del flat
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for doc, label in zip(docs, labels, strict=True):
        own = np.unique(np.concatenate(doc)) if doc else np.empty(0, np.int64)
        if len(own):
            counts[label].update(set(np.concatenate([hashes[stops[t] : stops[t + 1]] for t in own]).tolist()))
    inside, outside = counts[1], counts[0]
    pos, neg = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    found: dict[int, float] = {}
    for f, a in inside.items():
        b = outside.get(f, 0)
        if a < 3 or a / pos < 3 * b / neg:
            continue
        p = (a + b) / (pos + neg)
        ratio = a * math.log(a / (pos * p)) + (b * math.log(b / (neg * p)) if b else 0.0)
        if 2 * ratio >= least:
            found[f] = -ratio
    del counts, inside, outside
    named = {f: found[h] for token in tokens for f in features(token) if (h := hash(f)) in found}
    return {f: i for i, f in enumerate(sorted(named, key=lambda f: (named[f], f))[:most])}


def train(texts: list[str], labels: list[int], least: float = 13.0, most: int = 20_000, rounds: int = 400) -> Model:
    """Fit the sentence model to labels of whole texts by gradient ascent on the noisy-or likelihood (Adam)."""
    if len(set(labels)) < 2:
        return Model()
    tokens: dict[str, int] = {}
    docs = [[np.array([tokens.setdefault(t, len(tokens)) for t in s.split()], np.int32) for s in ENDS.split(x) if s.strip()] for x in texts]
    index = chosen(docs, list(tokens), labels, least, most)
    if not index:
        return Model()
    telling = {t: ids for token, t in tokens.items() if (ids := [index[f] for f in features(token) if f in index])}
    del tokens
    cols, rows, owner, idle = [], [], [], np.zeros(len(texts))
    for d, bag in enumerate(docs):
        for s in bag:
            ids = [i for t in s.tolist() if t in telling for i in telling[t]]
            if not ids:
                idle[d] += 1
                continue
            cols += ids
            rows += [len(owner)] * len(ids)
            owner.append(d)
    del docs
    cols, rows, owner = (np.array(x, dtype=np.int64) for x in (cols, rows, owner))
    y, w, base = np.array(labels, float), np.ones(len(index)), BASE_LOGIT
    # each class counts as much as the other
    share = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        z = base + np.bincount(rows, w[cols], len(owner))
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -500, 500))), 1 / (1 + math.exp(-base))
        clean = np.bincount(owner, -np.logaddexp(0, z), len(y)) + idle * math.log1p(-p0)
        toxic = np.clip(-np.expm1(clean), 1e-9, 1.0)
        pull = share * np.where(y == 1, np.exp(clean) / toxic, -1.0)  # d likelihood / d (sum of p)
        gz = pull[owner] * p
        gw = np.bincount(cols, gz[rows], len(w)) - 0.05 * w
        g = np.append(gw, gz.sum() + (pull * idle).sum() * p0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, base = w + step[:-1], min(BASE_LOGIT, base + step[-1])
    return Model({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}, float(base))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_per_class: int, max_chars: int) -> list[tuple[str, int]]:
    """Texts and labels of at most ``max_per_class`` documents a class outside the held-out fold."""
    marks = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    marks = materialize(marks, "marks")
    ids = [(i, label) for label in (0, 1) for i in few_ids(marks.where(F.col("toxic") == label).select("doc_id"), max_per_class)]
    if not ids:
        return []
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))  # 2 * max_per_class rows at most
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where(F.length("text").between(1, max_chars))
        .join(few, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    # a partition at a time: the driver's JVM need not hold the whole sample
    return sorted((r.text, r.toxic) for r in materialize(found, "labelled").toLocalIterator())


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = 2_000, max_chars: int = 50_000) -> Model:
    """Learn from labelled documents whose crc32(doc_id as text) mod 5 is not 0."""
    sample = labelled_sample(docs, labels, max_per_class, max_chars)
    return train([x for x, _ in sample], [y for _, y in sample])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score in [0, 1], predicted (score >= 0.5), and how many sentences are likelier toxic than not."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("n_toxic_sentences", T.LongType()),
        ]
    )
    held: list[Scorer] = []

    def of(piece: pa.RecordBatch) -> dict:
        if not held:
            held.append(model.scorer())
        scorer, texts = held[0], texts_of(piece)
        scores = [scorer.document(x) for x in texts]
        hits = [sum(z >= 0 for z in scorer.sentences(x)) if s >= 0.5 else 0 for x, s in zip(texts, scores, strict=True)]
        return {"doc_id": piece.column(0), "score": scores, "predicted": [int(s >= 0.5) for s in scores], "n_toxic_sentences": hits}

    return map_pieces(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), of, schema)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The offending sentences: doc_id, first and last + 1 character in the text, probability, sentence."""
    schema = "doc_id long, start long, stop long, probability double, sentence string"

    def run(batches):
        scorer = model.scorer()
        for piece in pieces(batches):
            out = []
            for doc_id, text in zip(piece.column(0).to_pylist(), texts_of(piece), strict=True):
                at = 0
                for end in [*((m.start(), m.end()) for m in ENDS.finditer(text or "")), (len(text or ""),) * 2]:
                    sentence = (text or "")[at : end[0]]
                    if tokens := sentence.split():
                        z = model.base + sum(scorer[t] for t in tokens)
                        if (p := 1 / (1 + math.exp(-max(z, -700.0)))) >= least:
                            out.append((doc_id, at, end[0], p, sentence))
                    at = end[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(list(zip(*out, strict=True)) or [[]] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()), strict=True)],
                names=["doc_id", "start", "stop", "probability", "sentence"],
            )

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)
