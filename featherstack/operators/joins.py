"""Joins by key.

Positional column concatenation in the reference becomes an equi left join
on the entity key.  No join is forced to broadcast: the planner broadcasts a
side by its size in bytes, at run time too (AQE), and else shuffles and splits
skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_features(base: DataFrame, features: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Base entity ⟕ each feature table (all keyed by the same entity key).

    Feature tables are aggregates with one row per key, so each join is a
    1:1 equi join; Catalyst/AQE choose sort-merge or broadcast by size.
    """
    out = base
    for f in features:
        out = out.join(f, key, "left")
    return out


def select_new_columns(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Columns of ``b`` absent from ``a`` (keys kept), joined onto ``a``."""
    keys = [key] if isinstance(key, str) else list(key)
    new = [c for c in b.columns if c not in set(a.columns)]
    return a.join(b.select(*keys, *new), keys, "left")


def column_set_difference(a: DataFrame, b: DataFrame) -> list[str]:
    bs = set(b.columns)
    return [c for c in a.columns if c not in bs]


def membership_isin(df: DataFrame, ids: DataFrame, key: str, flag: str = "is_member") -> DataFrame:
    """Flag rows whose key appears in an id list (a left semi join kept as a column).

    The id list is deduplicated first so the left join cannot multiply rows.
    """
    marks = ids.select(key).distinct().withColumn(flag, F.lit(1))
    return df.join(marks, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def map_lookup(df: DataFrame, key_cols: str | Sequence[str], table: DataFrame) -> DataFrame:
    """``col.map(series)``: left join with a lookup table keyed by category."""
    return df.join(table, key_cols, "left")


def null_columns_for_keys(df: DataFrame, ids: DataFrame, key: str, pattern: str) -> DataFrame:
    """For keys in ``ids``, set every column whose name contains ``pattern``
    (case-insensitive) to NULL; other rows are unchanged."""
    flagged = membership_isin(df, ids, key, "__null_me")
    targets = {c for c in df.columns if pattern.lower() in c.lower() and c != key}
    out = [F.when(F.col("__null_me") == 0, F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns]
    return flagged.select(*out)
