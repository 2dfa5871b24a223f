"""Shape statistics with the reference's bias conventions.

Spark's ``skewness``/``kurtosis`` are the population g1 and excess g2.
pandas reports the bias-corrected G1/G2; R's e1071 (type 3, its default)
reports b1/b2.  Conversion needs only n, so everything stays one aggregate.
A zero variance gives NULL (Spark's non-legacy statistical semantics).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def corrected_skew_from(g1: Column, n: Column, flavor: str = "pandas") -> Column:
    n = n.cast("double")
    if flavor == "pandas":
        return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    if flavor == "e1071":
        return F.when(n >= 1, g1 * F.pow((n - 1) / n, 1.5))
    if flavor == "population":
        return g1
    raise ValueError(flavor)


def corrected_kurt_from(g2: Column, n: Column, flavor: str = "pandas") -> Column:
    n = n.cast("double")
    if flavor == "pandas":
        return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    if flavor == "e1071":
        return F.when(n >= 1, (g2 + 3) * F.pow(1 - 1 / n, 2) - 3)
    if flavor == "population":
        return g2
    raise ValueError(flavor)


def skew(c: str | Column, flavor: str = "pandas") -> Column:
    """Aggregate: skewness of a column in the chosen flavour."""
    c = _col(c)
    return corrected_skew_from(F.skewness(c), F.count(c), flavor)


def kurt(c: str | Column, flavor: str = "pandas") -> Column:
    """Aggregate: excess kurtosis of a column in the chosen flavour."""
    c = _col(c)
    return corrected_kurt_from(F.kurtosis(c), F.count(c), flavor)
