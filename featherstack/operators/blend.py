"""Rank and mean blends of several score columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import melt, rank_columns, ranks_of


def rank_normalise(df: DataFrame, col: str, out: str) -> DataFrame:
    """``(1 + average rank) / (n + 1)`` with n the number of rows."""
    ranked = rank_columns(df, [col], "average", suffix="__r")
    n = df.count()
    return ranked.withColumn(out, (1 + F.col(col + "__r")) / F.lit(float(n + 1))).drop(col + "__r")


def rank_average(df: DataFrame, cols: Sequence[str], out: str, method: str = "min",
                 by: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Mean over columns of each column's rank (ties per ``method``), divided
    by the number of rows (per group).

    With ``key``, a unique column of ``df``, the columns are melted and all ranks
    come back in one join and one aggregate, however many columns there are;
    without it, in one join a column.  A NULL in any column gives NULL.
    """
    by = list(by)
    if key:
        long = melt(df, cols, [key, *by])
        ranks = ranks_of(long, method, by)
        same = [long[c].eqNullSafe(ranks[f"__of_{c}"]) for c in by] + [long["__name"] == ranks["__of_name"], long["__x"] == ranks["__v"]]
        mean = F.when(F.count("__r") == len(cols), F.sum("__r") / F.lit(float(len(cols))))
        means = long.join(ranks, same, "left").groupBy(F.col(key).alias("__key")).agg(mean.alias("__mean"))
        ranked, mean_rank = df.join(means, F.col(key) == F.col("__key"), "left").drop("__key"), F.col("__mean")
    else:
        ranked = rank_columns(df, cols, method, by, suffix="__r")
        mean_rank = sum((F.col(c + "__r") for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))
    spent = ["__mean", *[c + "__r" for c in cols]]
    if not by:
        return ranked.withColumn(out, mean_rank / F.lit(float(df.count()))).drop(*spent)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))  # combined map-side; no group in one window
    sizes = sizes.select(*[F.col(b).alias(f"__by_{b}") for b in by], "__rows")
    same = [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by]
    return ranked.join(sizes, same).withColumn(out, mean_rank / F.col("__rows")).drop("__rows", *[f"__by_{b}" for b in by], *spent)


def mean_blend(df: DataFrame, key: str, score: str, out: str = "score") -> DataFrame:
    """Average of several models' (or folds') scores per key (long input)."""
    return df.groupBy(key).agg(F.avg(score).alias(out))
