"""Quantile bins (``qcut(x, n, duplicates='drop')``) and optimal 1-d clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import cluster_of, fit_clusters
from .rank import global_quantiles


def fit_edges(df: DataFrame, cols: Sequence[str], n: int | dict[str, int], exact: bool = True,
              rel_err: float = 1e-4) -> dict[str, list[float]]:
    """Edges at the i/n quantiles (i = 0..n) of each column, duplicates dropped.

    ``n`` may differ per column (``{col: n}``); all columns are fitted in one
    pass.  ``exact`` uses the distributed exact quantiles (linear
    interpolation, as numpy); otherwise Spark's approximate quantile sketch.
    Only ``columns × probabilities`` numbers reach the driver.
    """
    ns = n if isinstance(n, dict) else {c: n for c in cols}
    per_col = {c: [i / ns[c] for i in range(ns[c] + 1)] for c in cols}
    probs = sorted({q for qs in per_col.values() for q in qs})
    if exact:
        got = global_quantiles(df, cols, probs)
    else:
        got = dict(zip(cols, df.approxQuantile(list(cols), probs, rel_err)))
    index = {q: i for i, q in enumerate(probs)}
    out = {}
    for c in cols:
        vals = [got[c][index[q]] for q in per_col[c]]
        out[c] = sorted({float(x) for x in vals if x is not None})
    return out


def quantile_bin(col: str | Column, edges: Sequence[float]) -> Column:
    """Bin index 0..len(edges)-2: bins are right-closed, the first also holds
    its left edge; values outside the fitted range fall into the end bins."""
    c = F.col(col) if isinstance(col, str) else col
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]]) if len(edges) > 2 else F.array().cast("array<double>")
    return F.when(c.isNotNull(), F.size(F.filter(inner, lambda e: e < c.cast("double")))).cast("int")


def clustered_value(col: str, fill: float = 999.0, log1p: bool = True) -> Column:
    """What a column's clusters are made of: missing values as ``fill``, then log1p."""
    x = F.coalesce(F.col(col).cast("double"), F.lit(fill))
    return F.log1p(F.greatest(x, F.lit(0.0))) if log1p else x


def kmeans_1d(df: DataFrame, col: str, k: int | Sequence[int], out: str, fill: float = 999.0, log1p: bool = True,
              fit_on: DataFrame | None = None) -> DataFrame:
    """Cluster ids, by ascending values, of one (log1p-transformed) column: the
    clusters of least squared error (see ``cluster``).  Several ``k`` give
    ``<out>_<k>`` each from one fit; ``fit_on`` is ``df`` unless given."""
    x = clustered_value(col, fill, log1p)
    begins = fit_clusters(df if fit_on is None else fit_on, x, k if isinstance(k, int) else list(k))
    return df.withColumns({out if isinstance(k, int) else f"{out}_{c}": cluster_of(x, b) for c, b in begins.items()})
