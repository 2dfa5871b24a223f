"""Ordered-history features per entity: latest values, last-k, n-th latest,
lagged differences, trends, extremes.

Scale rule: a single entity may hold a third of all rows, so no operator
here puts a whole entity's history into one window task.

* "latest value" / "first value" are ``max_by`` / ``min_by`` aggregates
  (partial aggregation combines a hot key map-side).
* top-k per entity is ``row_number() <= k``: Spark plans it with a partial
  ``WindowGroupLimit`` *below* the shuffle, so each map task ships at most k
  rows per key (a map-side top-k); a first phase ranks within salted parts of
  a key, which share those ``k × map tasks`` rows, and the final window sees
  at most ``k × salt`` rows of a hot key.
* extremes are aggregated per key and re-attached with a join on
  ``(key, time)``, which spreads a hot key by time.
* lagged differences are computed inside ranges of ``(key, time)``, which are
  linked by their first and last values.

Every "latest" needs a total order: pass a tiebreak column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..names import feature_name
from ..session import materialize
from .agg import Spec, _pairs, agg_expr

DEFAULT_SALT = 16  # parts that a key's first ranking is spread over


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def last_values(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], prefix: str,
                non_null: bool = True, first: bool = False) -> DataFrame:
    """Value of each column at the latest (or earliest) row per key.

    With ``non_null`` the latest *present* value is taken, like pandas
    ``groupby().last()``.
    """
    order = _list(order)
    pick = F.min_by if first else F.max_by
    tag = "first" if first else "last"
    exprs = []
    for c in cols:
        ordering = _order_struct(order)
        if non_null:
            ordering = F.when(F.col(c).isNotNull(), ordering)
        exprs.append(pick(F.col(c), ordering).alias(feature_name(prefix, c, tag)))
    return df.groupBy(key).agg(*exprs)


def first_last(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    """Value at the first and at the last row per key (NULLs included as values)."""
    order = _list(order)
    exprs = []
    for c in cols:
        exprs.append(F.min_by(F.col(c), _order_struct(order)).alias(feature_name(prefix, c, "first")))
        exprs.append(F.max_by(F.col(c), _order_struct(order)).alias(feature_name(prefix, c, "last")))
    return df.groupBy(key).agg(*exprs)


def top_k_per_group(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], k: int,
                    salt_cols: Sequence[str] | None = None, salt: int = DEFAULT_SALT,
                    rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..k per key by ``order`` (a total order), with their rank.

    With ``salt > 1`` a first phase ranks within ``(key, salt bucket)`` (the
    salt is a hash of ``salt_cols``, deterministic on retry) and the second
    ranks the ``<= k * salt`` survivors per key.
    """
    keys = _list(key)
    if salt > 1:
        salt_expr = F.pmod(F.xxhash64(*[F.col(c) for c in (salt_cols or [])]), F.lit(salt)) \
            if salt_cols else F.pmod(F.xxhash64(*order), F.lit(salt))
        w1 = Window.partitionBy(*keys, salt_expr).orderBy(*order)
        df = df.withColumn("__rn1", F.row_number().over(w1)).where(F.col("__rn1") <= k).drop("__rn1")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def last_k_agg(df: DataFrame, key: str, order_desc: Sequence[Column], spec: Spec, ks: Sequence[int],
               prefix: str, salt_cols: Sequence[str] | None = None, salt: int = DEFAULT_SALT,
               scales: dict[str, int] | None = None) -> DataFrame:
    """``sort; groupby().tail(k).agg(spec)`` for several k from ONE ranking.

    ``order_desc`` lists the ordering expressions newest first.
    """
    kmax = max(ks)
    ranked = top_k_per_group(df, key, order_desc, kmax, salt_cols, salt)
    exprs = []
    for k in ks:
        w = F.col("rn") <= k
        for col, fn in _pairs(spec):
            exprs.append(agg_expr(col, fn, w, (scales or {}).get(col))
                         .alias(feature_name(f"{prefix}_last{k}", col, fn)))
    return ranked.groupBy(key).agg(*exprs)


def trend_last_k(df: DataFrame, key: str, order_desc: Sequence[Column], y: str, ks: Sequence[int],
                 prefix: str, salt_cols: Sequence[str] | None = None, salt: int = DEFAULT_SALT) -> DataFrame:
    """Slope of ``y`` over the position of the last k rows (oldest → newest)."""
    kmax = max(ks)
    ranked = top_k_per_group(df, key, order_desc, kmax, salt_cols, salt)
    exprs = []
    for k in ks:
        w = F.col("rn") <= k
        x = F.when(w, (F.lit(k + 1) - F.col("rn")).cast("double"))
        yy = F.when(w, F.col(y).cast("double"))
        exprs.append(F.regr_slope(yy, x).alias(feature_name(f"{prefix}_last{k}", y, "slope")))
    return ranked.groupBy(key).agg(*exprs)


def extreme_rows(df: DataFrame, key: str, t: str, which: str = "max") -> DataFrame:
    """All rows at the per-key extreme of ``t`` (ties kept, like ``filter(t == max(t))``).

    The extreme is an aggregate; rows are matched back on ``(key, t)``.
    """
    ext = df.groupBy(key).agg((F.max(t) if which == "max" else F.min(t)).alias(t))
    return df.join(ext, [key, t], "left_semi")


def nth_latest_rows(df: DataFrame, key: str, t: str, n: int = 2, salt: int = DEFAULT_SALT) -> DataFrame:
    """Rows at the n-th latest *distinct* ``t`` per key (``dense_rank() = n``)."""
    distinct = df.select(key, t).where(F.col(t).isNotNull()).distinct()
    nth = top_k_per_group(distinct, key, [F.col(t).desc()], n, [t], salt).where(F.col("rn") == n)
    return df.join(nth.select(key, t), [key, t], "left_semi")


def last_entity_rows(df: DataFrame, key: str, entity: str, order: Sequence[str]) -> DataFrame:
    """All rows of the entity (e.g. loan) that is latest per key by ``order``."""
    last = df.groupBy(key).agg(F.max_by(F.col(entity), _order_struct(_list(order))).alias(entity))
    return df.join(last, [key, entity], "left_semi")


def lagged_diff_mean(df: DataFrame, key: str, t: str, tiebreak: str, col: str, names: Mapping[str, str], chunks: int | None = None) -> DataFrame:
    """Mean of consecutive differences of ``col`` per key ordered by ``(t, tiebreak)``.

    ``names`` gives the output for ``"null"`` (the first row has no difference,
    pandas ``diff``) and/or ``"zero"`` (it counts as 0, R ``c(0, diff(x))``).  A
    difference touching a missing value is missing and skipped by the mean;
    rows without a key are left out.

    A prefix scan: rows are sorted into ranges of ``(key, t, tiebreak)``, as many
    as the session's shuffle has (or ``chunks``), so a range holds many short
    keys or a piece of a long one, however its rows bunch in time.  Differences
    are taken inside ``(key, range)``; a range hands on its first and last value
    of each key, and these, one row a range, are linked in order.  Rows carry
    nothing but their range's number.
    """
    order = [F.col(t), F.col(tiebreak)]
    place = F.struct(*order)
    rows = df.select(key, t, tiebreak, col).where(F.col(key).isNotNull())
    ranges = (chunks, key, t, tiebreak) if chunks else (key, t, tiebreak)
    rows = materialize(rows.repartitionByRange(*ranges).withColumn("__chunk", F.spark_partition_id()))
    w = Window.partitionBy(key, "__chunk").orderBy(*order)
    rows = rows.withColumn("__prev", F.lag(col).over(w)).withColumn("__pos", F.row_number().over(w))
    rows = rows.withColumn("__diff", F.when(F.col("__pos") > 1, (F.col(col) - F.col("__prev")).cast("double")))
    parts = rows.groupBy(key, "__chunk").agg(F.max_by(F.col(col), place).alias("__last"), F.min_by(F.col(col), place).alias("__first"),
                                             F.sum("__diff").alias("__sum"), F.count("__diff").alias("__n"))
    before = F.lag("__last").over(Window.partitionBy(key).orderBy("__chunk"))
    parts = parts.withColumn("__join", (F.col("__first") - before).cast("double"))
    total = F.coalesce(F.sum("__sum"), F.lit(0.0)) + F.coalesce(F.sum("__join"), F.lit(0.0))
    n = F.sum("__n") + F.count("__join")
    forms = {"null": F.try_divide(total, n), "zero": total / (n + 1)}
    return parts.groupBy(key).agg(*[forms[k].alias(name) for k, name in names.items()])


def trend_exprs(y: str, x: str, prefix: str, where: Column | None = None, fill_y: float | None = None,
                intercept: bool = True) -> list[Column]:
    """Aggregate expressions of the least-squares line ``y ~ x`` (see ``trend_fit``)."""
    yy = F.col(y).cast("double")
    if fill_y is not None:
        yy = F.coalesce(yy, F.lit(float(fill_y)))
    xx = F.col(x).cast("double")
    if where is not None:
        yy, xx = F.when(where, yy), F.when(where, xx)
    both = xx.isNotNull() & yy.isNotNull()
    out = [F.regr_slope(yy, xx).alias(feature_name(prefix, y, "slope"))]
    if intercept:
        out.append(F.coalesce(F.regr_intercept(yy, xx), F.avg(F.when(both, yy))).alias(feature_name(prefix, y, "intercept")))
    return out


def trend_fit(df: DataFrame, key: str, y: str, x: str, prefix: str, where: Column | None = None,
              fill_y: float | None = None, intercept: bool = True) -> DataFrame:
    """Least-squares line ``y ~ x`` per key: slope and intercept.

    As R's ``lm``: constant x gives no slope and the intercept is mean(y).
    ``fill_y`` replaces a missing y before the fit.
    """
    return df.groupBy(key).agg(*trend_exprs(y, x, prefix, where, fill_y, intercept))
