"""Language ID by error-correcting output codes.

Each language has a codeword, a row of a Hadamard matrix, so any two differ
in half of their bits.  For every bit a binary logistic classifier on hashed
character n-grams (one to three bytes of the lower-cased text) predicts it.
Decoding sums, for each language, the logistic loss of the bit scores against
its codeword, each bit weighted by how well its classifier did on that
language in training; the smallest loss wins.  The score is the softmax of the
negative losses; a text whose two best languages score within ``margin`` is
flagged ambiguous.

The model is fitted in numpy on about ``ROWS`` labelled texts (a bounded
sample, as many of each language) and broadcast: BUCKETS x bits weights.

Cases: NULL text or text without letters is ``und`` with score 0; no labelled
rows make every text ``und``; one language only is predicted with score 1;
repeated rows are judged each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .features import dense, histograms, labelled_sample, ngrams, sample_features, score_column, sparse

BITS = 12
BUCKETS = 1 << BITS
ROWS = 4000  # labelled texts that a model is fitted on
ROUNDS = 150
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]")
#: lower case, other ASCII than letters blank, so that no digit, mark or white space counts
_LETTERS = bytes(c if 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def _grams(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    blank = data == 32
    for n in (1, 2, 3):
        yield ngrams(data, n, BITS, blank)


def features(texts: list[bytes]) -> np.ndarray:
    """Square roots of n-gram shares: rows of length one."""
    x = histograms([b" " + b" ".join(t.translate(_LETTERS).split()) + b" " for t in texts], _grams, BUCKETS)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))


def has_letters(text: bytes | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or _LETTER.search(text.decode("utf-8", "replace")) is not None)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1, any two at the same distance, without constant bits."""
    h = np.ones((1, 1), dtype=np.float32)
    while len(h) < max(8, 2 * n):
        h = np.block([[h, h], [h, -h]])
    rows = h[1:n + 1]
    return rows[:, np.abs(rows.sum(axis=0)) < n] if n > 1 else rows


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # BUCKETS x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits: how well each bit is told on each language, rows sum to 1
    margin: float

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        known = np.array([has_letters(t) for t in texts]) & bool(self.languages)
        p = self._shares(features([t or b"" for t in texts])) if self.languages else np.zeros((len(texts), 1))
        best = p.argmax(axis=1)
        score = np.where(known, p.max(axis=1), 0.0)
        second = np.partition(p, -2, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(texts))
        return ([self.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)], score,
                known & (score - second < self.margin))

    def _shares(self, x: np.ndarray) -> np.ndarray:
        f = (x @ self.weights + self.bias).astype(np.float64)
        loss = np.einsum("tlb,lb->tl", np.logaddexp(0, -f[:, None, :] * self.codes), self.trust)
        e = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return e / e.sum(axis=1, keepdims=True)


def fit(labels: list[str], x: np.ndarray, margin: float = 0.1) -> Model:
    languages = sorted(set(labels))
    if not languages:
        empty = np.zeros((0, 0), dtype=np.float32)
        return Model([], empty, empty, empty, empty, margin)
    codes = codewords(len(languages))
    own = np.array([languages.index(lang) for lang in labels])
    target = codes[own]
    share = np.bincount(own) / len(own)
    weight = (1 / (share[own] * len(languages) * len(own))).astype(np.float32)[:, None]  # languages count alike
    w, b = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    m, v, rate = [0, 0], [0, 0], 0.5
    for step in range(1, ROUNDS + 1):
        slope = -target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30))) * weight
        for i, (at, g) in enumerate(((w, x.T @ slope + 1e-6 * w), (b, slope.sum(axis=0)))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            at -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    right = (target * (x @ w + b) > 0).astype(np.float64)
    trust = np.array([right[own == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return Model(languages, codes, w, b, trust / trust.sum(axis=1, keepdims=True) * codes.shape[1], margin)


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          rows: int = ROWS, margin: float = 0.1) -> Model:
    """Fit on about ``rows`` rows of ``labelled`` (id, label), as many of each language."""
    labels, found = sample_features(docs, labelled_sample(labelled, id_col, label_col, rows), id_col, text_col,
                                   lambda t: sparse(features(t)))
    x = dense(found, BUCKETS)
    full = x.any(axis=1)
    return fit([lang for lang, k in zip(labels, full, strict=True) if k], x[full])


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def score(texts: list[bytes | None]) -> dict[str, pa.Array]:
            lang, p, unsure = sent.value.predict(texts)
            return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(p, pa.float64()), "ambiguous": pa.array(unsure, pa.bool_())}
        return score
    return score_column(docs, text_col, make, "lang_pred string, score double, ambiguous boolean")
