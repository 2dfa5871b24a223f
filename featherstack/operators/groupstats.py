"""Group statistics joined back onto every row (``do_count``/``do_mean``/
``do_countuniq`` and per-group recipes).

All statistics for one grouping key go into ONE aggregate; the per-group
table is joined back by its keys with ``skew.split_join``, which spreads the
rows of heavy keys (the planner broadcasts the table if its bytes are few).
An aggregate + join is used instead of ``count() over (partition by g)``
because a window would put a hot group into one task; the aggregate combines
it map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import feature_name
from .agg import agg_expr, picks
from .select import PROBS, Pick, aggregate
from .skew import split_join


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def group_recipes(df: DataFrame, recipes: Sequence[tuple[Sequence[str], Sequence[tuple[str, str]]]]) -> DataFrame:
    """``[(keys, [(col, stat), ...]), ...]``: each statistic per key set, joined back
    as ``grp_<keys>_<col>_<stat>``.  NULL keys never match (like pandas, which
    drops NaN groups)."""
    out = df
    for keys, stats in recipes:
        keys = _keys(keys)
        prefix = "grp_" + "_".join(keys)
        plain = [agg_expr(c, fn).alias(feature_name(prefix, c, fn)) for c, fn in stats if fn not in PROBS]
        out = split_join(out, aggregate(df, keys, plain, picks(stats, prefix)), keys, rows=df)
    return out


def group_medians(df: DataFrame, keys: Sequence[str] | str, names: Mapping[str, str]) -> DataFrame:
    """Exact medians per group, whatever its size.  ``names``: column to output."""
    return aggregate(df, _keys(keys), [], [Pick(n, c, PROBS["median"]) for c, n in names.items()])


def broadcast_count(df: DataFrame, keys: Sequence[str] | str, name: str | None = None) -> DataFrame:
    keys = _keys(keys)
    name = name or feature_name("cnt", "_".join(keys))
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return split_join(df, g, keys)


def broadcast_mean(df: DataFrame, cat: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each numeric column per level of ``cat``, as ``mean_<cat>_<col>``."""
    g = df.groupBy(cat).agg(*[F.avg(c).alias(f"mean_{cat}_{c}".lower()) for c in cols])
    return split_join(df, g, cat)


def broadcast_nunique(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """For every ordered pair (f0, f1) of categories: distinct f1 per f0 level,
    as ``nuniq_<f0>_<f1>``.  One aggregate per f0 (not one per pair), by distinct
    (f0, f1) rows, so no task holds a set of values."""
    out = df
    for f0 in cats:
        others = [f1 for f1 in cats if f1 != f0]
        g = df.groupBy(f0).agg(*[agg_expr(f1, "nunique").alias(f"nuniq_{f0}_{f1}".lower()) for f1 in others])
        out = split_join(out, g, f0, rows=df)
    return out
