"""Scalers, imputation, variance selection and truncated SVD.

Statistics are fitted on the training rows (fold-train inside OOF) and are a
bounded dict per column; applying them is a single projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import fill_from_stats, replace_columns
from .rank import global_quantiles


def fit_robust(train: DataFrame, cols: Sequence[str], lower: float = 5.0, upper: float = 95.0) -> dict[str, tuple]:
    qs = global_quantiles(train, cols, [0.5, lower / 100.0, upper / 100.0])
    out = {}
    for c in cols:
        med, lo, hi = qs.get(c, [None, None, None])
        rng = (hi - lo) if hi is not None and lo is not None else None
        out[c] = (med or 0.0, rng if rng else 1.0)  # zero range → scale 1
    return out


def robust_scale(train: DataFrame, df: DataFrame, cols: Sequence[str], lower: float = 5.0, upper: float = 95.0,
                 with_centering: bool = True) -> DataFrame:
    stats = fit_robust(train, cols, lower, upper)
    return replace_columns(df, {c: ((F.col(c) - F.lit(m if with_centering else 0.0)) / F.lit(r))
                                for c, (m, r) in stats.items()})


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-score with the population standard deviation (ddof = 0); zero → 1."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    new = {}
    for c in cols:
        m, s = row[f"m_{c}"] or 0.0, row[f"s_{c}"]
        new[c] = (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
    return replace_columns(df, new)


def median_impute(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    med = global_quantiles(train, cols, [0.5])
    return fill_from_stats(df, {c: med[c][0] for c in cols if c in med})


def variance_threshold(train: DataFrame, cols: Sequence[str], threshold: float = 0.03) -> list[str]:
    """Columns whose population variance exceeds ``threshold`` (one wide aggregate)."""
    row = train.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > threshold]


GRAM_DIM = 1024  # columns whose matrix of inner products is summed whole
OVERSAMPLE = 10
POWERS = 2
SPREAD = 64  # tasks that share the first sum of the matrices' rows


def _summed(x: DataFrame, dim: int, product: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows ``x`` (array<double>) of ``product`` of blocks of
    them; a task adds up its rows, and the rows of the matrices are summed by key."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = product(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])

    def merge(table: pa.Table) -> pa.Table:
        row = np.sum([np.frombuffer(r.as_buffer()) for r in table.column("row")], axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([row.tobytes()], pa.binary())})
    parts = x.mapInArrow(add, "i int, row binary").groupBy("i", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).applyInArrow(merge, "i int, row binary")
    found = sorted((r["i"], r["row"]) for r in parts.groupBy("i").applyInArrow(merge, "i int, row binary").collect())
    return np.array([np.frombuffer(r) for _, r in found])


def right_singular(x: DataFrame, dim: int, k: int, gram_dim: int = GRAM_DIM, oversample: int = OVERSAMPLE, powers: int = POWERS,
                   seed: int = 7) -> np.ndarray:
    """The first ``k`` right singular vectors (dim x k) of rows ``x`` of ``dim`` doubles.

    Up to ``gram_dim`` columns from the sum of X'X, exactly.  Beyond, by a
    randomised range finder: a sketch X'(X S) of a random S with a few more
    columns than ``k``, made orthonormal and multiplied ``powers`` times more,
    and the singular vectors inside that range; each is one sum over the rows,
    of dim x (k + oversample) numbers.
    """
    if dim <= gram_dim:
        total = _summed(x, dim, lambda b: b.T @ b)
        if not len(total):
            return np.zeros((dim, min(k, dim)))
        values, vectors = np.linalg.eigh(total)
        return vectors[:, np.argsort(-values)[:k]]
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, min(dim, k + oversample))))[0]
    for _ in range(powers + 1):
        sketch = _summed(x, dim, lambda b, q=basis: b.T @ (b @ q))
        if not len(sketch):
            return np.zeros((dim, k))
        basis = np.linalg.qr(sketch)[0]
    inner = _summed(x, dim, lambda b: (b @ basis).T @ (b @ basis))
    values, vectors = np.linalg.eigh(inner)
    return basis @ vectors[:, np.argsort(-values)[:k]]


def svd_reduce(df: DataFrame, vec_col: str, k: int, prefix: str = "svd") -> DataFrame:
    """Truncated SVD without centring: project rows on the top-k right singular
    vectors (X·V).  V (dim × k) is all that the plan carries.  The dimension is
    the most frequent length; NULL vectors, and those of another length, get
    NULL components and take no part in the fit.
    """
    x = df.select(F.col(vec_col).cast("array<double>").alias("x")).where("x IS NOT NULL AND NOT exists(x, e -> e IS NULL)")
    size = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = size["d"] if size else 0
    v = right_singular(x.where(F.size("x") == dim), dim, k) if dim else np.zeros((0, k))
    emb = F.col(vec_col)
    comps = []
    for j in range(v.shape[1]):
        w = F.array(*[F.lit(float(c)) for c in v[:, j]]).cast("array<double>")
        dot = F.aggregate(F.zip_with(emb, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, c: acc + c)
        comps.append(F.when(F.size(emb) == dim, dot).alias(f"{prefix}{j}"))
    return df.select("*", *comps)
