"""Scalar column functions: safe arithmetic, casts and simple transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: str | Column, b: str | Column) -> Column:
    """x/0 → NULL (never ±inf, never an ANSI error)."""
    return F.try_divide(_col(a), _col(b))


def safe_div_zero(a: str | Column, b: str | Column) -> Column:
    """A failed division gives 0.0."""
    return F.coalesce(F.try_divide(_col(a).cast("double"), _col(b)), F.lit(0.0))


def positive_part(c: str | Column, keep_null: bool = False) -> Column:
    """``x if x > 0 else 0``.  Python's lambda turns missing into 0; R's
    ``ifelse`` keeps it missing (``keep_null=True``)."""
    c = _col(c)
    out = F.greatest(c, F.lit(0))  # greatest skips NULL, so missing → 0
    return F.when(c.isNotNull(), out) if keep_null else out


def safe_int(c: str | Column) -> Column:
    """Parse to int, failure (or missing) → 0."""
    return F.coalesce(_col(c).try_cast("int"), F.lit(0))


def safe_sqrt(c: str | Column) -> Column:
    """sqrt of a negative number is NULL, not NaN."""
    c = _col(c)
    return F.when(c >= 0, F.sqrt(c))


def safe_log1p(c: str | Column) -> Column:
    c = _col(c)
    return F.when(c > -1, F.log1p(c))


TIE_BIAS = 2.0 ** -40  # relative nudge: decimal ties round the same way in any engine


def sig_round(c: str | Column, sig: int = 10) -> Column:
    """Round to ``sig`` significant digits with exact powers of ten only.

    Used to compare floating results across engines whose summation orders
    differ in the last bits; ``round(x*10^k)/10^k`` is evaluated with the same
    IEEE operations in any engine.  Data with few decimals produces exact
    decimal ties (e.g. a mean of cents over 8 rows); the value is nudged by a
    relative 2^-40 (far above a last-bit difference, far below the rounding
    step) so both engines round such ties the same way.
    """
    c = _col(c)
    y = c * F.lit(1.0 + TIE_BIAS)
    k = F.lit(sig - 1) - F.floor(F.log10(F.abs(c)))
    scaled_up = F.round(y * F.pow(F.lit(10.0), k)) / F.pow(F.lit(10.0), k)
    scaled_dn = F.round(y / F.pow(F.lit(10.0), -k)) * F.pow(F.lit(10.0), -k)
    return (F.when(c.isNull() | (c == 0) | F.isnan(c) | c.isin(float("inf"), float("-inf")), c)
            .when(k >= 0, scaled_up).otherwise(scaled_dn))


def relative_day(ts: str | Column, anchor: str) -> Column:
    """Days relative to an anchor date (negative in the past), like the
    reference's DAYS_* columns."""
    return F.datediff(F.to_date(_col(ts)), F.to_date(F.lit(anchor)))
