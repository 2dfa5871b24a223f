"""Hashed character n-grams of whole texts, many texts at a time in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extend, map_batches, unused, without

SLICE_BYTES = 1 << 20  # text whose n-grams are in memory at once
END = 0  # the byte between texts; NUL bytes inside a text are blanked


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text between END bytes, and where each text begins."""
    data = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.cumsum(sizes) - sizes + 1


def ngrams(data: np.ndarray, n: int, bits: int, break_at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, buckets) of the n-grams that hold no END; with ``break_at``
    (a flag per byte) also none of these in their inside."""
    size = len(data) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    ok = np.ones(size, dtype=bool)
    for k in range(n):
        part = data[k:k + size]
        h = (h ^ part) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        ok &= part != END
        if break_at is not None and 0 < k < n - 1:
            ok &= ~break_at[k:k + size]
    at = np.flatnonzero(ok)
    return at, ((h[at] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.int64)


def by_text(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.searchsorted(begins, places, side="right") - 1


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_BYTES."""
    first, size = 0, 0
    for i, t in enumerate(texts, 1):
        size += len(t)
        if size >= SLICE_BYTES or i == len(texts):
            yield first, i
            first, size = i, 0


def histograms(texts: list[bytes], grams: Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]], size: int) -> np.ndarray:
    """Counts of each bucket in each text; ``grams`` yields (places, buckets) of the joined bytes."""
    data, begins = join_texts(texts)
    out = np.zeros(len(texts) * size, dtype=np.float32)
    for places, buckets in grams(data):
        out += np.bincount(by_text(places, begins) * size + buckets, minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), size)


def labelled_sample(labelled: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """(id, label): about ``rows`` rows, as many of each label, chosen by a hash of the id.

    An id that is labelled several times is one row, with its smallest label.
    A class of fewer rows is taken whole.  The choice needs counts only, so no
    task or driver ranks the rows.
    """
    known = labelled.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    counts = known.groupBy("label").agg(F.count("*").alias("n")).collect()
    unit = F.xxhash64("id", F.lit("labelled sample")) / F.lit(2.0**64) + 0.5
    keep = F.lit(False)
    for r in counts:
        keep = keep | ((F.col("label") == F.lit(r["label"])) & (unit < F.lit(rows / len(counts) / r["n"])))
    return known.where(keep)


Sparse = tuple[np.ndarray, np.ndarray]  # columns and their values


def sparse(rows: np.ndarray) -> list[Sparse]:
    return [(at := np.flatnonzero(x), x[at]) for x in rows]


def dense(rows: list[Sparse], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.float32)
    for x, (at, value) in zip(out, rows, strict=True):
        x[at] = value
    return out


def sample_features(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str,
                    features: Callable[[list[bytes]], list[Sparse]]) -> tuple[list, list[Sparse]]:
    """The labels and sparse features of the sampled documents, in order of their ids.

    Texts stay on the executors: what comes back is one sparse row of bounded
    width for each row of the bounded sample; an id that several documents
    share has the smallest of their texts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    joined = rows.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))  # a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            for a, b in slices(texts):
                at, value = zip(*features(texts[a:b]), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("label").slice(a, b - a),
                     pa.array([x.astype("<u2").tobytes() for x in at], pa.binary()),
                     pa.array([x.astype("<f4").tobytes() for x in value], pa.binary())], names=["id", "label", "at", "value"])
    types = dict(joined.dtypes)
    got = map_batches(joined, run, f"id {types['id']}, label {types['label']}, at binary, value binary").toArrow().sort_by("id")
    at, value = ([np.frombuffer(x.as_buffer(), dtype) for x in got.column(c)] for c, dtype in (("at", "<u2"), ("value", "<f4")))
    return got.column("label").to_pylist(), list(zip(at, value, strict=True))  # views of one Arrow table


def score_column(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[bytes | None]], dict[str, pa.Array]]],
                 schema: str) -> DataFrame:
    """``docs`` with columns computed from whole texts in bounded slices; each
    task calls ``make`` for a function of texts (as bytes, None for NULL)."""
    fields = T.StructType.fromDDL(schema)
    docs = without(docs, *fields.names)
    helper = unused(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            texts = [t.as_py() for t in batch.column(helper)]
            for a, b in slices([t or b"" for t in texts]):
                yield extend(batch.slice(a, b - a), score(texts[a:b]), drop=[helper])
    return map_batches(docs.withColumn(helper, F.col(text_col).cast("binary")), run, T.StructType([*docs.schema, *fields]))
