"""Tie-aware ROC AUC, overall and per group, without a global sort.

AUC = Σ_v pos_v · (neg_below_v + ½ · neg_v) / (P · N) over distinct scores v
(the Mann-Whitney statistic).  Counts per distinct score come from the
distributed cumulative counts, so no task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import cumulative_counts


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (), name: str = "auc") -> DataFrame:
    by = list(by)
    y = F.col(label).cast("long")
    cc = cumulative_counts(df.where(F.col(label).isNotNull()), score, by,
                           weights={"__pos": y, "__neg": 1 - y})
    contrib = F.col("__pos") * (F.col("__neg__before") + 0.5 * F.col("__neg"))
    out = cc.groupBy(*by).agg(F.sum(contrib).alias("__s"), F.first("__pos__total").alias("n_pos"),
                              F.first("__neg__total").alias("n_neg"))
    return out.select(*by, F.try_divide(F.col("__s"), F.col("n_pos") * F.col("n_neg")).alias(name),
                      F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def fold_auc_mean(df: DataFrame, score: str, label: str, fold: str) -> DataFrame:
    per_fold = auc(df, score, label, [fold])
    return per_fold.agg(F.avg("auc").alias("fold_auc_mean"), F.count(F.lit(1)).alias("n_folds"))
