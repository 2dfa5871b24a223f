"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is a tf-idf vector of hashed word-shape n-grams: letters become ``a`` or
``A``, digits ``0``, other bytes stay, and a word that repeats the word before
it counts as a mark of its own.  A truncated SVD of about ``ROWS``
labelled texts (a bounded sample, half of each class) gives the latent space; the
labelled latent vectors, of unit length, are broadcast.

Every document, in blocks, is multiplied with all labelled vectors (exact
cosines); its ``neighbours`` nearest vote with their labels, weighted by a
power of the cosine.

Cases: a text without any n-gram (NULL, empty) or at no positive cosine gets
the share of label 1 among the labelled rows; no labelled rows: 0.5; one class
only: its value.  Ties at the last neighbour fall to the earlier labelled row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import dense, histograms, labelled_sample, ngrams, sample_features, score_column, sparse

BITS = 11
BUCKETS = 1 << BITS
RANK = 48
ROWS = 3000  # labelled texts that a model is fitted on
NEIGHBOURS = 15
SHARPNESS = 8  # power of the cosine that weights a vote
BLOCK = 512  # documents multiplied at once
_SHAPE = bytes(97 if 97 <= c < 123 or c > 127 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else 32 if c in (0, 9, 11, 12, 13) else c
               for c in range(256))
REPEAT = b"\x01"  # stands for a word that repeats the one before it


def _grams(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for n in (1, 2, 3, 4):
        yield ngrams(data, n, BITS)


def _shape(text: bytes) -> bytes:
    w = text.split()
    return b" ".join(REPEAT if a == b else a.translate(_SHAPE) for a, b in zip(w, [b"", *w], strict=False))


def features(texts: list[bytes]) -> np.ndarray:
    """Square roots of n-gram shares."""
    x = histograms([_shape(t) for t in texts], _grams, BUCKETS)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray  # BUCKETS x rank
    vectors: np.ndarray  # labelled texts x rank, rows of unit length
    labels: np.ndarray
    base: float

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.full(len(texts), self.base)
        if not len(self.labels) or self.labels.min() == self.labels.max():
            return out if not len(self.labels) else np.full(len(texts), float(self.labels[0]))
        for i in range(0, len(texts), BLOCK):
            x = _unit((features([t or b"" for t in texts[i:i + BLOCK]]) * self.idf) @ self.space)
            cosine = np.maximum(x @ self.vectors.T, 0).astype(np.float64)
            k = min(NEIGHBOURS, len(self.labels))
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.take_along_axis(cosine, near, axis=1) ** SHARPNESS
            total = vote.sum(axis=1)
            share = (vote * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
            out[i:i + BLOCK] = np.where(total > 0, np.clip(share, 0, 1), self.base)
        return out


def fit(labels: list[int], x: np.ndarray, base: float) -> Model:
    y = np.array(labels, dtype=np.float64)
    if not len(y):
        return Model(*(np.zeros((0, 0)),) * 3, y, base)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    x *= idf
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))  # right singular vectors, largest last
    space = vectors[:, ::-1][:, :min(RANK, len(x))].astype(np.float32)
    return Model(idf, space, _unit(x @ space), y, base)


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          rows: int = ROWS) -> Model:
    """Fit on about ``rows`` rows of ``labelled`` (id, label 0 or 1), half of each class."""
    base = labelled.agg(F.avg(label_col)).first()[0]
    labels, found = sample_features(docs, labelled_sample(labelled, id_col, label_col, rows), id_col, text_col,
                                   lambda t: sparse(features(t)))
    x = dense(found, BUCKETS)
    return fit(labels, x, 0.5 if base is None else float(base))


def predict(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if the score reaches ``threshold``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def score(texts: list[bytes | None]) -> dict[str, pa.Array]:
            p = sent.value.score(texts)
            return {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= threshold).astype(np.int32), pa.int32())}
        return score
    return score_column(docs, text_col, make, "score double, predicted int")
