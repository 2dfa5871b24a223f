"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (three to five bytes, with the
word's ends), hashed into BUCKETS vectors.  A text is the average of the
n-gram vectors of its words, each n-gram weighted by its inverse document
frequency in training and a repeated word by the root of its count, together
with SMOOTH n-grams of no weight that steady short texts; a linear softmax
tells toxic from not.  Vectors and softmax are trained together in numpy on
about ``ROWS`` labelled texts (a bounded sample, half of each class) and
broadcast.  A misspelt word that training never saw shares most n-grams with
the right one.

At scoring time each bucket's vector is folded with the softmax into one
number, so a word is one number too, which workers remember.

Cases: NULL, empty and wordless texts get the share of label 1 among the
labelled rows; no labelled rows: 0.5; one class only: its value.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Sparse, by_text, join_texts, labelled_sample, ngrams, sample_features, score_column

BITS = 16
BUCKETS = 1 << BITS
DIM = 16
ROWS = 3000  # labelled texts that a model is fitted on
EPOCHS = 30
BATCH = 64
RATE = 10.0
SMOOTH = 300
DAMP = 0.5
CACHE = 400_000  # words that a worker remembers
_LETTERS = bytes(c if 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def _bags(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of distinct words."""
    data, begins = join_texts([b" " + w + b" " for w in words])
    parts = [ngrams(data, n, BITS) for n in (3, 4, 5)]
    return by_text(np.concatenate([p for p, _ in parts]), begins), np.concatenate([b for _, b in parts])


def _counts(text: bytes | None) -> Counter[bytes]:
    return Counter((text or b"").translate(_LETTERS).split())


def features(texts: list[bytes]) -> list[Sparse]:
    """Shares of each bucket in each text, before weighting by document frequency."""
    out = []
    for text in texts:
        count = _counts(text)
        word, bucket = _bags(list(count))
        at, where = np.unique(bucket, return_inverse=True)
        weight = np.fromiter(count.values(), np.float64, len(count)) ** DAMP
        share = np.bincount(where, weight[word], minlength=len(at))
        out.append((at, (share / (share.sum() + SMOOTH)).astype(np.float32)))
    return out


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS x DIM, weighted by document frequency
    softmax: np.ndarray  # DIM x 2
    bias: np.ndarray
    base: float  # score of a text without n-grams


class Scorer:
    """Scores texts with a model; remembers words."""

    def __init__(self, model: Model):
        self.model = model
        self.known = len(model.vectors) > 0
        if self.known:
            self.each = (model.vectors @ (model.softmax[:, 1] - model.softmax[:, 0])).astype(np.float64)
            self.bias = float(model.bias[1] - model.bias[0])
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.total, self.size = np.zeros(0), np.zeros(0)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not self.known:
            return np.full(len(texts), self.model.base)
        counts = [_counts(t) for t in texts]
        if len(self.words) > CACHE:
            self._forget()
        new = list(set().union(*counts).difference(self.words))
        if new:
            word, bucket = _bags(new)
            self.words.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
            self.total = np.concatenate([self.total, np.bincount(word, self.each[bucket], minlength=len(new))])
            self.size = np.concatenate([self.size, np.bincount(word, minlength=len(new))])
        out = np.full(len(texts), self.model.base)
        for i, count in enumerate(counts):
            if count:
                at = np.fromiter(map(self.words.__getitem__, count), np.int64, len(count))
                weight = np.fromiter(count.values(), np.float64, len(count)) ** DAMP
                z = weight @ self.total[at] / (weight @ self.size[at] + SMOOTH) + self.bias
                out[i] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return out


def fit(labels: list[int], rows: list[Sparse], base: float, seed: int = 1) -> Model:
    y = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        none = np.zeros((0, DIM), np.float32)
        return Model(none, np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32), float(y[0]) if len(y) else base)
    texts_with = np.zeros(BUCKETS)
    for at, _ in rows:
        texts_with[at] += 1
    idf = np.log((1 + len(rows)) / (1 + texts_with)).astype(np.float32)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    softmax = rng.normal(0, 0.25, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weight = (len(y) / (2 * np.bincount(y, minlength=2)))[y].astype(np.float32)
    size, step = np.zeros(3), 0  # mean square of each gradient: one step size for all of a parameter
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            at, step = order[i:i + BATCH], step + 1
            used = np.unique(np.concatenate([rows[k][0] for k in at]))
            x = np.zeros((len(at), len(used)), np.float32)
            for j, k in enumerate(at):
                x[j, np.searchsorted(used, rows[k][0])] = rows[k][1] * idf[rows[k][0]]
            mean = x @ vectors[used]
            z = mean @ softmax + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), y[at]] -= 1
            p *= weight[at, None] / len(at)
            grads = (x.T @ (p @ softmax.T), mean.T @ p, p.sum(axis=0))
            size = 0.99 * size + 0.01 * np.array([float((g * g).sum()) for g in grads])
            rate = (1 - epoch / EPOCHS) / (np.sqrt(size / (1 - 0.99**step)) + 1e-12)
            vectors[used] -= RATE * rate[0] * grads[0]
            softmax -= 0.02 * rate[1] * grads[1]
            bias -= 0.02 * rate[2] * grads[2]
    return Model(vectors * idf[:, None], softmax, bias, base)


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = ROWS) -> Model:
    """Fit on about ``rows`` rows of ``labelled`` (id, label 0 or 1), half of each class."""
    base = labelled.agg(F.avg(label_col)).first()[0]
    labels, found = sample_features(docs, labelled_sample(labelled, id_col, label_col, rows), id_col, text_col, features)
    return fit(labels, found, 0.5 if base is None else float(base))


def predict(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if the score reaches ``threshold``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(sent.value)

        def score(texts: list[bytes | None]) -> dict[str, pa.Array]:
            p = scorer.score(texts)
            return {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= threshold).astype(np.int32), pa.int32())}
        return score
    return score_column(docs, text_col, make, "score double, predicted int")
