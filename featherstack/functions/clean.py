"""Cleaning: one missing-value concept (SQL NULL), sentinels, bounds, fills, flags.

Every helper returns either a ``Column`` or a ``DataFrame`` built with a
single ``select`` so that wide tables never grow through ``withColumn`` loops.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Replace (or append) columns in one projection, keeping column order."""
    out = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    out += [expr.alias(name) for name, expr in new.items() if name not in df.columns]
    return df.select(*out)


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)]


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN and NULL are one concept in the reference; keep only NULL."""
    cols = list(cols) if cols is not None else floating_columns(df)
    return replace_columns(df, {c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def inf_to_null(c: str | Column) -> Column:
    c = _col(c)
    return F.when(~c.isin(float("inf"), float("-inf")) & ~F.isnan(c), c)


def sentinel_to_null(df: DataFrame, sentinels: Mapping[str, Any]) -> DataFrame:
    """``{col: value or [values]}``: listed values become NULL."""
    new = {}
    for c, vals in sentinels.items():
        vals = list(vals) if isinstance(vals, (list, tuple, set, frozenset)) else [vals]
        new[c] = F.when(~F.col(c).isin(*vals), F.col(c))
    return replace_columns(df, new)


def outlier_to_null(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    """``{col: predicate}``: rows where the predicate holds become NULL; NULL stays NULL."""
    return replace_columns(df, {c: F.when(~F.coalesce(p, F.lit(False)), F.col(c)) for c, p in bad.items()})


def cap_value(c: str | Column, upper: float) -> Column:
    """Clip at an upper bound; NULL stays NULL (``least`` alone would skip it)."""
    c = _col(c)
    return F.when(c > upper, F.lit(upper)).otherwise(c)


def clip_range(c: str | Column, lower: float, upper: float) -> Column:
    c = _col(c)
    return F.when(c.isNull(), c).otherwise(F.greatest(F.least(c, F.lit(upper)), F.lit(lower)))


def fill_constant(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return replace_columns(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def membership_flag(c: str | Column, values: Iterable[Any]) -> Column:
    """``x %in% values`` as 0/1; missing is not a member."""
    return F.coalesce(_col(c).isin(*list(values)), F.lit(False)).cast("int")


def collapse_rare(c: str | Column, keep: Iterable[Any], other: str = "Other") -> Column:
    """Values outside ``keep`` (missing included) become ``other``."""
    c = _col(c)
    return F.when(F.coalesce(c.isin(*list(keep)), F.lit(False)), c).otherwise(F.lit(other))


def missing_flag(c: str | Column) -> Column:
    return _col(c).isNull().cast("int")


def compare_flag(pred: Column) -> Column:
    """``(c > k).astype(int)``: a missing comparison counts as 0."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def not_equal_keep_null(c: str | Column, value: Any) -> Column:
    """pandas ``!=``: a missing value is 'not equal' and so is kept."""
    return ~_col(c).eqNullSafe(F.lit(value))


def boolean_to_number(df: DataFrame) -> DataFrame:
    bools = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return replace_columns(df, {c: F.col(c).cast("int") for c in bools})


def fill_from_stats(df: DataFrame, stats: Mapping[str, Any]) -> DataFrame:
    """Fill NULLs from a bounded dict of fitted statistics (one value per column)."""
    return replace_columns(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in stats.items() if v is not None})
