"""Across-column (row-wise) statistics as built-in expressions.

pandas row statistics skip missing values; so do these, and NaN is missing as
NULL is.  Each statistic is one expression over the array of a row's present
values, so its size grows with the columns, not with their square, and no UDF
runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .moments import corrected_kurt_from, corrected_skew_from


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _present(cols: Sequence[str | Column]) -> Column:
    """The row's values that are not missing, as an array of doubles."""
    return F.filter(F.array(*[c.cast("double") for c in _cols(cols)]), lambda x: x.isNotNull() & ~F.isnan(x))


def _total(values: Column, f: Callable[[Column], Column] = lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + f(x))


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _moments(cols: Sequence[str | Column], f: Callable[[Column, Callable[[int], Column]], Column]) -> Column:
    """``f(n, m)`` of the count of present values and their sums of powers about the mean."""
    return _bind(_present(cols), lambda v: _bind(F.try_divide(_total(v), F.size(v)), lambda mean: f(
        F.size(v).cast("double"), lambda power: _total(v, lambda x: F.pow(x - mean, power)))))


def row_count_present(cols: Sequence[str | Column]) -> Column:
    return F.size(_present(cols))


def row_missing_count(cols: Sequence[str | Column]) -> Column:
    """Columns of any type that are NULL (or a floating NaN) in the row."""
    def missing(c: Column) -> Column:
        return c.isNull() | (F.typeof(c).isin("double", "float") & (c.cast("string") == "NaN"))
    return sum((F.coalesce(missing(c), F.lit(True)).cast("int") for c in _cols(cols)), F.lit(0))


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Sum of present values; all missing → 0 (pandas ``sum(axis=1)``)."""
    return _total(_present(cols))


def row_flag_sum(cols: Sequence[str | Column]) -> Column:
    return sum((F.coalesce(c, F.lit(0)) for c in _cols(cols)), F.lit(0))


def row_mean(cols: Sequence[str | Column]) -> Column:
    return _bind(_present(cols), lambda v: F.try_divide(_total(v), F.size(v)))


def row_std(cols: Sequence[str | Column]) -> Column:
    return _moments(cols, lambda n, m: F.when(n >= 2, F.sqrt(m(2) / (n - 1))))


def row_min(cols: Sequence[str | Column]) -> Column:
    return F.array_min(_present(cols))


def row_max(cols: Sequence[str | Column]) -> Column:
    return F.array_max(_present(cols))


def row_median(cols: Sequence[str | Column]) -> Column:
    def middle(v: Column) -> Column:
        n = F.size(v)
        lo, hi = F.get(v, F.floor((n - 1) / 2).cast("int")), F.get(v, F.floor(n / 2).cast("int"))
        return F.when(n > 0, (lo + hi) / 2)
    return _bind(F.array_sort(_present(cols)), middle)


def row_skew(cols: Sequence[str | Column], flavor: str = "pandas") -> Column:
    return _moments(cols, lambda n, m: _bind(F.try_divide(m(2), n), lambda m2: corrected_skew_from(
        F.when(m2 > 0, m(3) / n / F.pow(m2, 1.5)), n, flavor)))


def row_kurt(cols: Sequence[str | Column], flavor: str = "pandas") -> Column:
    return _moments(cols, lambda n, m: _bind(F.try_divide(m(2), n), lambda m2: corrected_kurt_from(
        F.when(m2 > 0, m(4) / n / F.pow(m2, 2) - 3), n, flavor)))


ROW_FUNCS = {
    "mean": row_mean, "std": row_std, "sum": row_sum, "median": row_median,
    "min": row_min, "max": row_max, "skew": row_skew, "kurt": row_kurt,
    "missing": row_missing_count, "present": row_count_present,
}


def row_stat(fn: str, cols: Sequence[str | Column], name: str) -> Column:
    """One named row statistic."""
    return ROW_FUNCS[fn](cols).alias(name)


def row_stats(cols: Sequence[str | Column], fns: Sequence[str], prefix: str) -> list[Column]:
    """Named row statistics ``{prefix}_{fn}`` over the given columns."""
    return [row_stat(f, cols, f"{prefix}_{f}") for f in fns]
