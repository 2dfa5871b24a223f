"""Linear models from sufficient statistics: one pass over the rows, any number of fits.

A row is the vector (1, features…, target).  One pass sums the outer products
of every fold; what reaches the driver is one (p + 2) x (p + 2) matrix a fold
and no row.  The training rows of fold f are then "all folds minus f", so every
fold and penalty is a subtraction and a Cholesky solve, and a backward
elimination is a series of rank-one downdates of one inverse.

Tasks add up their rows in numpy; the matrices' rows are summed by key in two
steps, the first shared by SPREAD tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 4096  # rows whose outer products are added at once
TIE_DECIMALS = 9
SPREAD = 64  # tasks that share the first sum of the matrices' rows


def _vector(features: Sequence[str], *more: Column) -> Column:
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features], *more)


def fold_grams(rows: DataFrame, features: Sequence[str], target: str, fold: str | None = None, weight_col: str | None = None) -> dict:
    """{fold: matrix of sums of the outer products of (1, features…, target)}; missing features count 0."""
    rows = rows.where(F.col(target).isNotNull())
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    key = F.col(fold).cast("int") if fold else F.lit(0)
    x = rows.select(key.alias("f"), weight.alias("w"), F.concat(F.array(F.lit(1.0)), _vector(features, F.col(target).cast("double"))).alias("x"))
    size = len(features) + 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int | None, np.ndarray] = {}
        for batch in batches:
            folds = np.array(batch.column("f").to_pylist(), dtype=object)
            weights = batch.column("w").to_numpy(zero_copy_only=False)
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for f in dict.fromkeys(folds.tolist()):
                at = np.flatnonzero([v == f for v in folds])
                for begin in range(0, len(at), ROWS):
                    part = values[at[begin:begin + ROWS]]
                    total.setdefault(f, np.zeros((size, size)))
                    total[f] += (part * weights[at[begin:begin + ROWS], None]).T @ part
        for f, g in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * size, pa.int32()), pa.array(range(size), pa.int32()),
                                              pa.array([r.tobytes() for r in g], pa.binary())], names=["f", "i", "g"])

    def merge(table: pa.Table) -> pa.Table:
        row = np.sum([np.frombuffer(g.as_buffer()) for g in table.column("g")], axis=0)
        return pa.table({"f": table.column("f").slice(0, 1), "i": table.column("i").slice(0, 1), "g": pa.array([row.tobytes()], pa.binary())})
    parts = x.mapInArrow(add, "f int, i int, g binary")
    some = parts.groupBy("f", "i", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).applyInArrow(merge, "f int, i int, g binary")
    found = some.groupBy("f", "i").applyInArrow(merge, "f int, i int, g binary").collect()
    out: dict = {}
    for r in found:
        out.setdefault(r["f"], np.zeros((size, size)))[r["i"]] = np.frombuffer(r["g"])
    return dict(sorted(out.items(), key=lambda kv: (kv[0] is None, kv[0])))


def ridge(gram: np.ndarray, alpha: float) -> np.ndarray:
    """Coefficients without intercept: the minimum of ``|y - Xb|^2 + alpha |b|^2``."""
    a, b = gram[1:-1, 1:-1], gram[1:-1, -1]
    low = np.linalg.cholesky(a + alpha * np.eye(len(a)))
    return np.linalg.solve(low.T, np.linalg.solve(low, b))


def ridge_fits(grams: Mapping, alphas: Sequence[float]) -> dict[tuple, np.ndarray]:
    """{(fold, alpha): coefficients of the fit on all other folds}."""
    total = sum(grams.values())
    return {(f, a): ridge(total - g, a) for f, g in grams.items() for a in alphas}


def _dot(x: Column, coefficients: np.ndarray) -> Column:
    w = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def ridge_oof(train: DataFrame, test: DataFrame | None, key: str, target: str, features: Sequence[str], fold: str,
              alphas: Sequence[float], weight_col: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Long tables (key, fold, alpha, score) of the held-out rows, each scored by
    the fit that did not see its fold, and of the test rows under every fit."""
    grams = fold_grams(train, features, target, fold, weight_col)
    if None in grams:
        raise ValueError(f"{int(grams[None][0, 0])} training rows have no {fold}")
    fits = ridge_fits(grams, alphas)
    x = F.col("__x")
    vectors = train.where(F.col(target).isNotNull()).select(key, fold, _vector(features).alias("__x"))
    each = []
    for a in alphas:
        score = F.lit(None).cast("double")
        for f in grams:
            score = F.when(F.col(fold) == F.lit(f), _dot(x, fits[f, a])).otherwise(score)
        each.append(F.struct(F.lit(float(a)).alias("alpha"), score.alias("score")))
    held = vectors.select(key, fold, F.explode(F.array(*each)).alias("s")).select(key, fold, "s.*")
    if test is None:
        return held, None
    each = [F.struct(F.lit(f).cast("int").alias(fold), F.lit(float(a)).alias("alpha"), _dot(x, c).alias("score")) for (f, a), c in fits.items()]
    scored = test.select(key, _vector(features).alias("__x")).select(key, F.explode(F.array(*each)).alias("s")).select(key, "s.*")
    return held, scored


def backward_elimination(gram: np.ndarray, features: Sequence[str], keep: int, step: int = 2, alpha: float = 1.0) -> tuple[list[str], list[str]]:
    """(names kept, names in the order in which they left).

    Features are standardised, so the sizes of their ridge coefficients compare
    (a constant one is 0); each step drops the ``step`` weakest, those equal to
    TIE_DECIMALS decimals by name.
    A column leaves by a downdate of the inverse: no rows, and no new solve.
    """
    n, names = gram[0, 0], list(features)
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(centred)[:-1] / n, 0.0))
    sd = np.where(sd > 1e-12 * np.maximum(1.0, np.abs(mean[:-1])), sd, np.inf)
    a, b = centred[:-1, :-1] / np.outer(sd, sd), centred[:-1, -1] / sd
    inverse = np.linalg.inv(a + alpha * np.eye(len(names)))
    weight, gone = inverse @ b, []
    while len(names) > keep:
        order = sorted(range(len(names)), key=lambda i: (round(abs(weight[i]), TIE_DECIMALS), names[i]))[:min(step, len(names) - keep)]
        for name in [names[i] for i in order]:
            j = names.index(name)
            column = inverse[:, j] / inverse[j, j]
            weight = np.delete(weight - column * weight[j], j)
            inverse = np.delete(np.delete(inverse - np.outer(column, inverse[j]), j, 0), j, 1)
            names.pop(j)
            gone.append(name)
    return names, gone
