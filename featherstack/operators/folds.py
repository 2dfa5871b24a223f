"""Fold assignment and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODULUS = 2147483647
MULTIPLIER = 48271


def fold_of(key: str | Column, k: int = 5, seed: int = 1001) -> Column:
    """A deterministic shuffled fold from the key alone:
    ``((key * 48271 + seed) mod (2^31 - 1)) mod k``.  The key is reduced
    first so the product never overflows."""
    c = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(F.pmod(c.cast("long"), F.lit(MODULUS)) * MULTIPLIER + seed, F.lit(MODULUS)), F.lit(k)) \
        .cast("int")


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 1001, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(key, k, seed))


def folds_from_table(df: DataFrame, folds: DataFrame, key: str) -> DataFrame:
    """Use a supplied fold table (key, fold)."""
    return df.join(folds, key, "inner")


def class_weight(label: str, positive_weight: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
