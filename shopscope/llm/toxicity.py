"""Toxicity by multiple-instance learning (operator 5).

Only whole documents are labelled.  A document is a bag of sentences; each
sentence has a logistic score from hashed word and word-stem features, and
the document is toxic with the noisy-or of its sentences,
``1 - prod(1 - p_sentence)``.  The weights are trained from document labels
through that noisy-or, on a bounded sample of labelled rows
(``train_rows``, taken in the order of a hash of the id).  The same sentence
scores then locate the offending sentences of every document.

Cases: null and empty texts score 0 (no sentence, empty product); very long
texts are read whole, sentence by sentence; repeated rows score alike, and an
id with several labels counts as toxic if any label says so; without labels
of both kinds the model has no weights and scores the share of toxic labels
(0 without any) for texts with words; an empty table gives no rows; other
columns of ``docs`` and ``labels`` play no part.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_or_empty

#: Labelled documents used for training, at most.
TRAIN_ROWS = 8000
#: Feature space, and the training documents that a feature must occur in to be kept.
BUCKETS = 1 << 18
LEAST_DOCUMENTS = 3
#: Only features whose share of toxic documents is so many times the share of all are evidence.
LEAST_LIFT = 1.5
#: Lengths of the word beginnings that are features beside the word.
STEMS = (4, 5)
ROUNDS = 200
STEP = 1.0
SPARSITY = 2e-5
#: Sentences at least this likely are reported as offending.
SENTENCE_THRESHOLD = 0.5
MEMO_WORDS = 150_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_NOT_LETTER = re.compile(r"[^\w]+")


def word_features(word: str) -> list[int]:
    """Hashed features of a raw word: the bare lower-case word and its beginnings."""
    bare = _NOT_LETTER.sub("", word).lower()
    if not bare:
        return []
    names = ["w" + bare, *(f"{n}{bare[:n]}" for n in STEMS if len(bare) >= n)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


@dataclass
class Model:
    """Weights by feature, bias of a sentence, and the score of texts where nothing was learnt."""

    weights: np.ndarray
    bias: float
    constant: float | None = None


def _evidence(texts: list[str], y: np.ndarray) -> np.ndarray:
    """Which features occur in enough toxic documents, and there more often than elsewhere."""
    among, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    memo: dict[str, list[int]] = {}
    for text, toxic in zip(texts, y):
        own: set[int] = set()
        for word in set(text.split()):
            got = memo.get(word)
            if got is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                got = memo[word] = word_features(word)
            own.update(got)
        seen = np.fromiter(own, np.int64, len(own))
        among[seen] += 1
        bad[seen] += toxic
    return (bad >= LEAST_DOCUMENTS) & (bad >= LEAST_LIFT * y.mean() * among)


def _bags(texts: list[str], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept features of all sentences in a row, the sentence of each, the document of each sentence."""
    memo: dict[str, list[int]] = {}
    flat, sentences, owners = array("i"), array("i"), array("i")
    for doc, text in enumerate(texts):
        for m in _SENTENCE.finditer(text):
            words = m.group().split()
            if not words:
                continue
            for word in words:
                got = memo.get(word)
                if got is None:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    got = memo[word] = [f for f in word_features(word) if kept[f]]
                if got:
                    flat.extend(got)
                    sentences.extend([len(owners)] * len(got))
            owners.append(doc)
    return tuple(np.asarray(x, np.int64) for x in (flat, sentences, owners))


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Maximum likelihood of the document labels under the noisy-or, with sparse weights."""
    y = np.asarray(toxic, bool)
    if not len(y) or y.all() or not y.any():
        return Model(np.zeros(BUCKETS, np.float32), 0.0, float(y.mean()) if len(y) else 0.0)
    flat, sentence, owner = _bags(texts, _evidence(texts, y))
    weights, bias = np.zeros(BUCKETS), -7.0
    square = np.full(BUCKETS, 1e-8)
    square_bias = 1e-8
    n = len(owner)
    for _ in range(ROUNDS):
        z = np.clip(np.bincount(sentence, weights[flat], n) + bias, -30, 30)
        hazard = np.bincount(owner, np.logaddexp(0, z), len(y))
        pull = np.where(y, -1.0 / np.expm1(np.clip(hazard, 1e-9, 500)), 1.0)
        slope = pull[owner] / (1 + np.exp(-z)) / len(y)
        grad = np.bincount(flat, slope[sentence], BUCKETS)
        square += grad * grad
        weights -= STEP * grad / np.sqrt(square)
        shrink = STEP * SPARSITY / np.sqrt(square)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0)
        square_bias += slope.sum() ** 2
        bias -= STEP * slope.sum() / np.sqrt(square_bias)
    return Model(weights.astype(np.float32), float(bias))


class Scorer:
    """Scores texts with a model; words keep their summed weights in a bounded memo."""

    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, float] = {}

    def _word(self, word: str) -> float:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            got = self.memo[word] = float(sum(self.model.weights[f] for f in word_features(word)))
        return got

    def text(self, text: str) -> tuple[float, list[dict]]:
        """Score of a whole text and its offending sentences (start, end, score; code points)."""
        if self.model.constant is not None:
            return (self.model.constant if text.split() else 0.0), []
        z, spans = [], []
        for m in _SENTENCE.finditer(text):
            words = m.group().split()
            if words:
                z.append(sum(map(self._word, words)) + self.model.bias)
                spans.append(m.span())
        if not z:
            return 0.0, []
        z = np.clip(np.asarray(z), -30, 30)
        score = float(-np.expm1(-np.logaddexp(0, z).sum()))
        found = []
        for i in np.flatnonzero(z >= np.log(SENTENCE_THRESHOLD / (1 - SENTENCE_THRESHOLD))):
            found.append({"start": spans[i][0], "end": spans[i][1], "score": float(1 / (1 + np.exp(-z[i])))})
        return min(1.0, max(0.0, score)), found


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, those with the least hash of their id."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    chosen = marks.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    # One text per id: of repeated rows the smallest.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    found = sorted(sample.collect())
    return fit([r["text"] for r in found], [int(r["toxic"] > 0) for r in found])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, offending) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            got = [scorer.text(t.as_py()) for t in batch.column(1)]
            spans = pa.array([g[1] for g in got], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.float64()), spans], ["doc_id", "score", "offending"]
            )

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return wanted.mapInArrow(
        give_back(run), "doc_id long, score double, offending array<struct<start: long, end: long, score: double>>"
    )


def accepted(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([scorer.text(t.as_py() or "")[0] < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(give_back(run), docs.schema)
