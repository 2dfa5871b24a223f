"""Sinks: submissions, out-of-fold predictions, evaluations, fold scores.

Every writer takes a target folder on shared storage; nothing is collected
to the driver.  Prediction stores are partitioned by model (and fold) so a
reader of one model prunes the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_submission(scored: DataFrame, key: str, score: str, path: str, target: str = "TARGET",
                     fmt: str = "csv") -> str:
    """``(key, TARGET)`` for the test rows."""
    return write_table(scored.select(key, F.col(score).alias(target)), path, fmt)


def write_oof(oof: DataFrame, key: str, score: str, model: str, path: str, target: str = "TARGET") -> str:
    """Out-of-fold predictions of one model into a store partitioned by model.

    Only this model's partition is replaced, so a retried job leaves the store
    as one run does.
    """
    out = oof.select(key, F.col(score).alias(target), F.lit(model).alias("model"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)
    return path


def write_scored_name(df: DataFrame, root: str, auc_value: float, stem: str, fmt: str = "csv") -> str:
    """Write under a folder whose name carries the validation score."""
    path = f"{root.rstrip('/')}/{stem}_{auc_value:.6f}"
    return write_table(df, path, fmt)


def persist_evaluation(scored: DataFrame, key: str, target: str, score: str, path: str) -> str:
    return write_table(scored.select(key, target, F.col(score).alias("y_pred")), path)


def write_fold_scores(scores: DataFrame, path: str) -> str:
    return write_table(scores.repartition(1), path, "csv")  # one row a fold


def verify_submission(submission: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Same rows as the sample: every key once, none missing, none extra (order
    is not a property of a distributed table).  One-row result; ``ok`` is the
    verdict.  NULL keys count as keys."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(name)).withColumn(f"{name}_k", F.col("k")).drop("k")
    s, t = counted(submission, "s"), counted(sample, "t")
    j = s.join(t, s["s_k"].eqNullSafe(t["t_k"]), "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = j.agg(total("s").alias("n_submission"), total("t").alias("n_sample"), F.count_if(F.col("s").isNull()).alias("n_missing"),
                F.count_if(F.col("t").isNull()).alias("n_extra"), F.count_if(F.col("s") > 1).alias("n_repeated"))
    return out.withColumn("ok", (F.col("n_submission") == F.col("n_sample")) & (F.col("n_missing") == 0)
                          & (F.col("n_extra") == 0) & (F.col("n_repeated") == 0))
