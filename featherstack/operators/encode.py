"""Categorical encoders.

Codes (label, factor, appearance, and the code whose binary digits are written)
come from a level table: the distinct levels, numbered in order by a range
sort, joined to the rows.  Any number of levels will do.  Encodings with one
column per level (one-hot, contrasts) take an explicit level list and are
JVM-side literal lookups.

* label: sorted text levels → 0-based code; missing is the text ``'nan'``
* factor: sorted levels → 1-based code; missing stays missing
* appearance: order of first appearance (by a row-order column); missing → -1
* one-hot, binary digits, Helmert and orthogonal-polynomial contrasts
* target: smoothed level mean of the target, fitted without the row's fold
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .agg import discover_levels, level_name
from .skew import split_join


def _map_lit(pairs: Mapping) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs.items()))


def fit_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted text levels of each column (one distinct pass for all), for outputs with a column per level."""
    return discover_levels(df, cols)


def level_codes(df: DataFrame, col: str, order: str | None = None) -> DataFrame:
    """(``__lv``, ``__code``): the non-null levels of ``col`` as text, numbered from 0
    in text order, or by the first row (smallest ``order``) where they appear.

    Levels are sorted into ranges, numbered inside each range and shifted by the
    sizes of the ranges before it: one number per range reaches the driver.
    """
    first = F.min(order) if order else F.lit(0)
    levels = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("__lv")).agg(first.alias("__first"))
    ranged = materialize(levels.repartitionByRange("__first", "__lv").withColumn("__part", F.spark_partition_id()))
    sizes = sorted((r["__part"], r["count"]) for r in ranged.groupBy("__part").count().collect())
    before, total = {}, 0
    for part, n in sizes:
        before[part], total = total, total + n
    within = F.row_number().over(Window.partitionBy("__part").orderBy("__first", "__lv")) - 1
    offset = _map_lit({k: int(v) for k, v in before.items()}) if before else F.lit(0)
    shift = F.coalesce(F.element_at(offset, F.col("__part")), F.lit(0)) if before else offset
    return ranged.select("__lv", (within + shift).cast("int").alias("__code"))


def _with_code(df: DataFrame, level: Column, codes: DataFrame) -> DataFrame:
    return split_join(df.withColumn("__lv", level), codes, "__lv")


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """sklearn LabelEncoder on ``astype(str)``: missing becomes the level 'nan'."""
    level = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    codes = level_codes(df.select(level.alias("__l")), "__l")
    return _with_code(df, level, codes).withColumnRenamed("__code", out).drop("__lv")


def factor_code(df: DataFrame, col: str, out: str) -> DataFrame:
    """Sorted levels from 1; missing stays missing."""
    coded = _with_code(df, F.col(col).cast("string"), level_codes(df, col))
    return coded.withColumn(out, F.col("__code") + 1).drop("__lv", "__code")


def factorize_code(df: DataFrame, col: str, order: str, out: str) -> DataFrame:
    """Levels from 0 by first appearance; missing is -1."""
    coded = _with_code(df, F.col(col).cast("string"), level_codes(df, col, order))
    return coded.withColumn(out, F.coalesce("__code", F.lit(-1))).drop("__lv", "__code")


def one_hot(col: str, levels: Sequence[str], null_level: bool = False, prefix: str | None = None) -> list[Column]:
    prefix = prefix or col
    out = [F.coalesce((F.col(col).cast("string") == F.lit(v)), F.lit(False)).cast("int")
           .alias(f"{prefix}_{level_name(v)}".lower()) for v in levels]
    if null_level:
        out.append(F.col(col).isNull().cast("int").alias(f"{prefix}_nan".lower()))
    return out


def binary_encode(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """1-based ordinal code written in base-2 digit columns (most significant
    first); missing is code 0 (all digits 0)."""
    prefix = prefix or col
    codes = level_codes(df, col)
    n_digits = max(1, int(codes.count()).bit_length())
    code = F.coalesce(F.col("__code") + 1, F.lit(0))
    digits = {f"{prefix}_bin{i}".lower(): F.shiftright(code, n_digits - 1 - i).bitwiseAND(1) for i in range(n_digits)}
    return _with_code(df, F.col(col).cast("string"), codes).withColumns(digits).drop("__lv", "__code")


def helmert_matrix(k: int) -> np.ndarray:
    """Helmert contrasts (k levels × k-1 columns): level i, column j (1-based)
    is -1 if i < j, j if i == j, 0 if i > j."""
    m = np.zeros((k, max(k - 1, 0)))
    for j in range(1, k):
        m[:j, j - 1] = -1.0
        m[j, j - 1] = float(j)
    return m


def polynomial_matrix(k: int) -> np.ndarray:
    """Orthonormal polynomial contrasts over equally spaced levels (degree 1..k-1)."""
    x = np.arange(k, dtype=float)
    vander = np.vander(x - x.mean(), k, increasing=True)
    q, r = np.linalg.qr(vander)
    q = q * np.sign(np.diag(r))
    return q[:, 1:]


def contrast_encode(col: str, levels: Sequence[str], matrix: np.ndarray, tag: str, prefix: str | None = None) -> list[Column]:
    """Apply a (levels × columns) contrast matrix; missing rows get 0s."""
    prefix = prefix or col
    lv = sorted(levels)
    out = []
    for j in range(matrix.shape[1]):
        lookup = _map_lit({v: float(matrix[i, j]) for i, v in enumerate(lv)})
        out.append(F.coalesce(F.element_at(lookup, F.col(col).cast("string")), F.lit(0.0)).alias(f"{prefix}_{tag}{j}".lower()))
    return out


def smoothing_weight(n: Column, min_samples_leaf: float, smoothing: float) -> Column:
    """1 / (1 + exp(-(n - min_samples_leaf) / smoothing))."""
    return 1.0 / (1.0 + F.exp(-(n - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))


def target_encode(df: DataFrame, col: str, target: str, fold: str, out: str, min_samples_leaf: float = 1.0,
                  smoothing: float = 1.0) -> DataFrame:
    """Smoothed target mean of ``col``'s level, fitted without the row's own fold.

    Rows with a NULL fold (test rows) use every labelled row.  One aggregate
    gives sums per (level, fold); the level, fold and grand totals are sums of
    that small table, which is written once, and the out-of-fold statistic is
    "total minus own fold".  A level unseen in the other folds gets the prior.
    Blend: ``prior·(1-s) + mean·s`` with ``s = smoothing_weight(n)``.
    """
    lab = df.where(F.col(target).isNotNull() & F.col(fold).isNotNull())
    lv = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    per = materialize(lab.groupBy(lv.alias("__lv"), F.col(fold).alias("__f")).agg(
        F.sum(F.col(target).cast("double")).alias("__lf_sum"), F.count(F.lit(1)).alias("__lf_cnt")))
    tot = per.groupBy("__lv").agg(F.sum("__lf_sum").alias("__lv_sum"), F.sum("__lf_cnt").alias("__lv_cnt"))
    by_fold = per.groupBy("__f").agg(F.sum("__lf_sum").alias("s"), F.sum("__lf_cnt").alias("n")).collect()  # one row a fold
    gs, gn = float(sum(r["s"] for r in by_fold)), int(sum(r["n"] for r in by_fold))
    levels = df.withColumn("__lv", lv)
    rows = split_join(levels, tot, "__lv")
    rows = split_join(rows, per.withColumnRenamed("__f", fold), ["__lv", fold], rows=levels)
    n = F.coalesce(F.col("__lv_cnt"), F.lit(0)) - F.coalesce(F.col("__lf_cnt"), F.lit(0))
    s = F.coalesce(F.col("__lv_sum"), F.lit(0.0)) - F.coalesce(F.col("__lf_sum"), F.lit(0.0))
    prior = F.lit(gs / gn if gn else None).cast("double")
    for r in by_fold:
        rest = gn - r["n"]
        prior = F.when(F.col(fold) == F.lit(r["__f"]), F.lit((gs - float(r["s"])) / rest if rest else None).cast("double")).otherwise(prior)
    w = smoothing_weight(n.cast("double"), min_samples_leaf, smoothing)
    value = F.when(n > 0, prior * (1 - w) + F.try_divide(s, n.cast("double")) * w).otherwise(prior)
    return rows.withColumn(out, value).drop("__lv", "__lv_sum", "__lv_cnt", "__lf_sum", "__lf_cnt")
