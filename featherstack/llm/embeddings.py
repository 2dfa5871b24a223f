"""Embedding near-dedup: sign hashing in several tables, exact cosines, components.

``bits`` random hyperplanes give a vector's key in each of ``tables`` tables.
Bits grow with the logarithm of the number of vectors, so buckets of unrelated
vectors stay small, and the tables with them, so that a pair just at the
threshold still meets in some table with probability ``RECALL``.

Keys are counted first, in narrow rows; only vectors that share a bucket are
shuffled with their data.  A bucket of more than BLOCK vectors is cut into
blocks and every pair of blocks is a task's group of bounded size, multiplied
as one matrix in double precision.  No pair is written: a group returns, for
each vector, how many links were found and the smallest vector it connects to.
A pair that meets in several tables is counted where it meets first.

Cases: vectors that are NULL, zero, or hold NULL or non-finite components link
with nothing, as do vectors of another length; rows that share an id share a
result and do not link with each other; a NULL id links with nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups, map_arrow, map_batches, stage_table
from .components import connected_components

RECALL = 0.99
BLOCK = 1024
SEED = 20240


def shape(n: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = max(6, math.ceil(math.log2(max(n, 2))) - 2)
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def _matrix(column: pa.Array, dtype: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length among the usable vectors."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    begin = np.cumsum(size) - size  # NULL lists have no values
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)  # a NULL component is NaN
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        x = values[begin[at][:, None] + np.arange(n)]
        largest = np.abs(x).max(axis=1)
        ok = np.isfinite(largest) & (largest > 0)
        if ok.any():
            x = x[ok].astype(np.float64)  # scaled by a power of two, which changes no direction and no rounding
            yield at[ok], np.ldexp(x, -np.frexp(largest[ok].astype(np.float64))[1][:, None]).astype(dtype)


def _keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = (x.astype(np.float64) @ _planes(x.shape[1], bits, tables) > 0).reshape(len(x), tables, bits)
    return (signs << np.arange(bits, dtype=np.int64)).sum(axis=2)


def _links(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    x, y = x.astype(np.float64), y.astype(np.float64)
    dot = x @ y.T
    return dot / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :] >= cosine


def _roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id reachable inside a symmetric link matrix."""
    root = ids.copy()
    a, b = np.nonzero(near)
    while len(a):
        new = root.copy()
        np.minimum.at(new, a, root[b])
        if (new == root).all():
            break
        root = new
    return root


def find_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
               recall: float = RECALL) -> DataFrame:
    """One row per vector: ``id``, ``n_links``, ``component_id``, ``kept``."""
    element = vectors.schema[vector_col].dataType.elementType
    dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    bits, tables = shape(rows.where("id IS NOT NULL AND v IS NOT NULL").count(), cosine, recall)

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        ids = batch.column("id")
        for at, x in _matrix(batch.column("v"), dtype):
            keys = _keys(x, bits, tables)
            out.append(pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                names=["id", "v", "keys"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None
    signed = stage_table(map_arrow(rows.where("id IS NOT NULL"), sign, f"id {id_type}, v binary, keys array<long>"))

    # the length of a vector is part of its bucket; buckets of one vector go before any vector moves
    narrow = signed.select("id", F.length("v").alias("size"), F.posexplode("keys").alias("t", "key"))
    shared = narrow.groupBy("t", "key", "size").agg(F.count("*").alias("n")).where("n > 1")
    met = narrow.join(shared, ["t", "key", "size"]).select("id", "t", "key", "size", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id", "t"), F.col("blocks")).cast("int")
    paired = met.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select("id", "t", "key", "size", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = paired.join(signed, "id").select("t", "key", "size", "i", "j", "own", "id", "v", "keys")
    full = full.repartition("t", "key", "size", "i", "j").sortWithinPartitions("t", "key", "size", "i", "j", "own", "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for group in groups(batches, ["t", "key", "size", "i", "j"]):
            found = _group(group, dtype, cosine)
            if found is not None:
                got.append(found)
            if len(got) >= 1000:
                yield _rows(got)
                got = []
        if got:
            yield _rows(got)
    partial = stage_table(map_batches(full, verify, f"id {id_type}, n long, root {id_type}"))
    counts = partial.groupBy("id").agg(F.sum("n").alias("n_links"))
    parts = connected_components(partial.select(F.col("id").alias("u"), F.col("root").alias("v")))
    out = rows.select("id").join(counts, "id", "left").join(parts, "id", "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("id")).alias("kept"))


def _rows(got: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got, strict=True)], names=["id", "n", "root"])


def _group(group: pa.RecordBatch, dtype: str, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(id, links met first here, smallest id connected) of a pair of blocks, or of one block with itself."""
    n = group.num_rows
    if n < 2:
        return None
    ids = group.column("id").to_numpy()
    x = np.frombuffer(b"".join(group.column("v").to_pylist()), dtype).reshape(n, -1)
    i, j, t = (group.column(c)[0].as_py() for c in ("i", "j", "t"))
    left = int((group.column("own").to_numpy() == i).sum()) if i != j else n
    if i != j and left in (0, n):
        return None
    a, b = (np.arange(left), np.arange(left, n)) if i != j else (np.arange(n), np.arange(n))
    near = _links(x[a], x[b], cosine) & (ids[a][:, None] != ids[b][None, :])
    if not near.any():
        return None
    p, q = np.nonzero(near)
    p, q = a[p], b[q]
    both = np.zeros((n, n), dtype=bool)
    both[p, q] = both[q, p] = True
    once = p < q
    p, q = p[once], q[once]
    used = np.unique(np.concatenate([p, q]))
    if t:
        keys = np.array(group.column("keys").take(pa.array(used)).to_pylist(), dtype=np.int64)[:, :t]
        first = np.ones(len(p), dtype=bool)
        pk, qk = np.searchsorted(used, p), np.searchsorted(used, q)
        for k in range(0, len(p), 100_000):
            first[k:k + 100_000] = (keys[pk[k:k + 100_000]] != keys[qk[k:k + 100_000]]).all(axis=1)
        p, q = p[first], q[first]
    links = np.bincount(p, minlength=n) + np.bincount(q, minlength=n)
    return ids[used], links[used].astype(np.int64), _roots(both, ids)[used]
