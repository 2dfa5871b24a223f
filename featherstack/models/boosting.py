"""Real AdaBoost (SAMME.R for two classes) of stumps over histograms.

Features are binned once, to one byte each (at most BINS quantile bins, the
distinct values where they are fewer).  A round is one pass: tasks work out
their rows' weights from the stumps so far, by table look-ups in numpy, and add
up the weights of each (feature, bin, class); the sums of all tasks are a few
kilobytes a feature, and the driver takes the split of least Gini impurity from
them.  Nothing is rewritten between rounds, no lineage grows, and a lost
executor costs the current pass only.

A leaf's share p of the positive class becomes ``h = log(p / (1 - p)) / 2``; the
score adds ``rate * h`` and weights are ``exp(-score * y)`` with y = -1, 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import positions_up_to
from ..session import materialize

BINS = 255
EPS = 1e-6


@dataclass(frozen=True)
class Stump:
    """Rows whose ``feature`` falls in a bin up to ``cut`` score ``low``, others ``high``."""
    feature: int
    cut: int
    low: float
    high: float


@dataclass(frozen=True)
class Ensemble:
    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]  # the smallest value of each bin but the first
    stumps: tuple[Stump, ...]
    rate: float


def fit_bins(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """The smallest value of each bin but the first, for each feature; all features in one pass."""
    grid = [i / bins for i in range(bins + 1)]
    found = df.agg(*[F.percentile_approx(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)), grid, 100 * bins).alias(f"e{i}")
                     for i, c in enumerate(features)]).first()
    return [sorted(set(found[i] or ()))[1:] for i in range(len(features))]


def _binned(features: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """The bin numbers of a row's features, less 128 so that they are bytes."""
    bins = []
    for c, e in zip(features, edges, strict=True):
        x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
        bins.append((positions_up_to(F.array(*[F.lit(v) for v in e]).cast("array<double>"), x) - 128).cast("byte"))
    return F.array(*bins)


def scores(bins: np.ndarray, stumps: Sequence[Stump], rate: float) -> np.ndarray:
    """Scores of rows of bin numbers (from 0)."""
    out = np.zeros(len(bins))
    for s in stumps:
        out += rate * np.where(bins[:, s.feature] <= s.cut, s.low, s.high)
    return out


def best_stump(sums: np.ndarray) -> Stump:
    """The split of least weighted Gini impurity from weights (feature, bin, class); of equal ones the first."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    total = sums[0].sum(axis=0)
    right = total - left
    size_l, size_r = left.sum(axis=2), right.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = 2 * (np.where(size_l > 0, left[..., 0] * left[..., 1] / size_l, 0) + np.where(size_r > 0, right[..., 0] * right[..., 1] / size_r, 0))
    impurity = np.where((size_l > 0) & (size_r > 0), impurity, np.inf)
    if not np.isfinite(impurity).any():  # one bin everywhere: no split
        p = _half_logit(total)
        return Stump(0, sums.shape[1], p, p)
    least = impurity.min()
    f, cut = np.unravel_index(int(np.flatnonzero(impurity.ravel() <= least * (1 + 1e-12))[0]), impurity.shape)
    return Stump(int(f), int(cut), _half_logit(left[f, cut]), _half_logit(right[f, cut]))


def _half_logit(weights: np.ndarray) -> float:
    p = min(max(weights[1] / weights.sum(), EPS), 1 - EPS)
    return 0.5 * float(np.log(p / (1 - p)))


def _pass(rows: DataFrame, stumps: Sequence[Stump], rate: float, n_features: int) -> np.ndarray:
    """Weights by (feature, bin, class) under the stumps so far."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_features, BINS + 1, 2))
        for batch in batches:
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features).astype(np.int64) + 128
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            w = np.exp(-scores(bins, stumps, rate) * (2 * y - 1))
            for f in range(n_features):
                total[f] += np.bincount(bins[:, f] * 2 + y, weights=w, minlength=2 * (BINS + 1)).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(range(n_features), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["f", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        row = np.sum([np.frombuffer(s.as_buffer()) for s in table.column("sums")], axis=0)
        return pa.table({"f": table.column("f").slice(0, 1), "sums": pa.array([row.tobytes()], pa.binary())})
    found = rows.mapInArrow(add, "f int, sums binary").groupBy("f").applyInArrow(merge, "f int, sums binary").collect()
    out = np.zeros((n_features, BINS + 1, 2))
    for r in found:
        out[r["f"]] = np.frombuffer(r["sums"]).reshape(BINS + 1, 2)
    return out


def fit_adaboost(train: DataFrame, features: Sequence[str], label: str, rounds: int = 150, rate: float = 0.3) -> Ensemble:
    """``train`` has the features (missing ones count 0) and a 0/1 label; rows without a label take no part."""
    known = train.where(F.col(label).isNotNull())
    edges = fit_bins(known, features)
    rows = materialize(known.select(_binned(features, edges).alias("bins"), F.col(label).cast("int").alias("label")))
    stumps: list[Stump] = []
    for _ in range(rounds):
        sums = _pass(rows, stumps, rate, len(features))
        if not sums.sum():
            break
        stumps.append(best_stump(sums))
    return Ensemble(tuple(features), tuple(map(tuple, edges)), tuple(stumps), rate)


def adaboost_score(model: Ensemble, df: DataFrame, out: str = "score") -> DataFrame:
    """Ensemble score squashed to (0, 1): sigmoid(2 * sum of rate * h), one table
    look-up for each feature in a single projection."""
    tables = [np.zeros(len(e) + 1) for e in model.edges]
    for s in model.stumps:
        tables[s.feature] += model.rate * np.where(np.arange(len(tables[s.feature])) <= s.cut, s.low, s.high)
    total = F.lit(0.0)
    for c, e, t in zip(model.features, model.edges, tables, strict=True):
        if t.any():
            x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
            at = positions_up_to(F.array(*[F.lit(v) for v in e]).cast("array<double>"), x)
            total = total + F.get(F.array(*[F.lit(float(v)) for v in t]), at)
    return df.withColumn(out, 1.0 / (1.0 + F.exp(-2.0 * total)))
