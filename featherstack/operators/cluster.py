"""Optimal clusters of one column: the k-means of least squared error, exactly.

In one dimension clusters are runs of the sorted values, so the best cut of
n weighted values into k runs is a dynamic programme over prefix sums; the best
start of a run never moves left as its end moves right, which a divide and
conquer over ends uses (k n log n steps, a whole depth of it at a time in
numpy).  There is no random start and nothing to converge.

Spark reduces the rows to distinct values with counts.  Beyond ``MAX_POINTS``
of them, values are first summed in that many bins of about equal numbers of
rows; the result is then the best one that cuts no bin.  So at most MAX_POINTS
points reach the driver, and what goes back is k - 1 numbers in the plan, by
which a row finds its cluster with a binary search.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import positions_up_to

MAX_POINTS = 16_384


def _points(df: DataFrame, x: Column, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first value, weight, mean) of the distinct values, or of bins of them, in order."""
    values = df.select(x.cast("double").alias("x")).where("x IS NOT NULL")
    found = values.groupBy("x").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(found) <= most:
        v, n = (np.array([r[i] for r in found], dtype=np.float64) for i in (0, 1))
        order = np.argsort(v)
        return v[order], n[order], v[order]
    grid = [i / most for i in range(1, most)]
    edges = values.agg(F.array_sort(F.array_distinct(F.percentile_approx("x", grid, 4 * most)))).first()[0]
    array = F.from_json(F.lit("[" + ",".join(map(repr, edges)) + "]"), "array<double>")
    bins = values.groupBy(positions_up_to(array, F.col("x")).alias("b")).agg(F.min("x"), F.count(F.lit(1)), F.avg("x"))
    found = np.array(sorted(tuple(r)[1:] for r in bins.collect()), dtype=np.float64)
    return found[:, 0], found[:, 1], found[:, 2]


def _layer(before: np.ndarray, cost, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(least cost, start of the last run) for every end, with one more run than ``before``."""
    n = len(before)
    best, start = np.full(n, np.inf), np.zeros(n, dtype=np.int32)
    left, right, low, high = (np.array([v]) for v in (first, n - 1, first, n - 1))
    while len(left):
        mid = (left + right) // 2
        size = np.minimum(mid, high) - low + 1
        offset = np.cumsum(size) - size
        i = np.arange(int(size.sum())) + np.repeat(low - offset, size)
        value = before[i - 1] + cost(i, np.repeat(mid, size))
        least = np.minimum.reduceat(value, offset)
        place = np.where(value == np.repeat(least, size), i, n)
        at = np.minimum.reduceat(place, offset)
        best[mid], start[mid] = least, at
        left, right, low, high = (np.concatenate(p) for p in ((left, mid + 1), (mid - 1, right), (low, at), (at, high)))
        some = left <= right
        left, right, low, high = left[some], right[some], low[some], high[some]
    return best, start


def optimal_cuts(values: np.ndarray, weights: np.ndarray, k: int) -> tuple[list[int], float]:
    """(places where clusters 1, 2, ... begin, sum of squares) of the best ``k`` runs of ascending values; of equal cuts the leftmost."""
    n = len(values)
    if n == 0:
        return [], 0.0
    x = values - np.average(values, weights=weights)
    w, s, q = (np.concatenate([[0.0], np.cumsum(c)]) for c in (weights, weights * x, weights * x * x))

    def cost(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.maximum(q[j + 1] - q[i] - (s[j + 1] - s[i]) ** 2 / (w[j + 1] - w[i]), 0.0)
    best = cost(np.zeros(n, dtype=np.int64), np.arange(n))
    starts = []
    for c in range(1, min(k, n)):
        best, start = _layer(best, cost, c)
        starts.append(start)
    cuts, end = [], n - 1
    for start in reversed(starts):
        cuts.append(int(start[end]))
        end = cuts[-1] - 1
    return cuts[::-1], float(best[n - 1])


def fit_clusters(df: DataFrame, x: Column, k: int | list[int], most: int = MAX_POINTS) -> dict[int, list[float]]:
    """For each ``k``, the smallest value of each cluster but the first."""
    first, weight, mean = _points(df, x, most)
    return {c: [float(first[i]) for i in optimal_cuts(mean, weight, c)[0]] for c in ([k] if isinstance(k, int) else k)}


def cluster_of(x: Column, begins: list[float]) -> Column:
    """The cluster of a value, numbered from 0 by ascending values."""
    array = F.array(*[F.lit(v) for v in begins]).cast("array<double>")
    return F.when(x.isNotNull(), positions_up_to(array, x.cast("double"))).cast("int")
