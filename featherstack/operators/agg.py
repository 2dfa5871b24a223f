"""Spec-driven grouped aggregation.

A spec is ``{column: [statistic, ...]}`` (or a list of ``(column, statistic)``
pairs).  Every statistic becomes one aliased aggregate expression, and all
specs that share a grouping key go into ONE ``groupBy().agg()``: subsets
(active/closed, approved/refused) are conditional aggregates in the same
pass instead of separate scans.  All statistics but quantiles are
partial-aggregatable, so a hot key is combined map-side before the shuffle;
exact quantiles (``median``, ``q25``, ``q75``, ``iqr``) are :class:`select.Pick`
and come from ``select.aggregate``, which splits large groups.

A wide spec over many small groups is the exception: map-side combining hardly
shortens the input there, and a group's buffers (and for several distinct counts
the expanded rows) are many times as wide as its rows.  ``agg_multi_spec`` then
deals the rows themselves by key and computes all statistics where they land;
rows of heavy keys still go the other way.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import kurt, skew
from ..names import feature_name
from .select import PROBS, Pick, aggregate
from .skew import bucket_of, heavy_buckets

Spec = Mapping[str, Sequence[str]] | Sequence[tuple[str, str]]

WIDE = 16  # statistics from which a spec is wide
GROUP_SHARE = 16  # rows a group, on average, from which partial aggregates are expected to be fewer than rows
DEALT_ROWS = 1_000_000  # rows to a task where rows are dealt by key
DEALT_VALUES = 8_000_000  # and statistics of all its groups, whose buffers stay in memory
HEAVY_CUTS = 1024  # a bucket of keys with more than this part of all rows is heavy


def _pairs(spec: Spec) -> list[tuple[str, str]]:
    if isinstance(spec, Mapping):
        return [(c, fn) for c, fns in spec.items() for fn in fns]
    return list(spec)


def _mask(c: Column, where: Column | None) -> Column:
    return c if where is None else F.when(where, c)


def _size(c: Column, where: Column | None) -> Column:
    return F.count(F.lit(1)) if where is None else F.count_if(where)


# statistic name -> builder(column, where) -> aggregate Column
AGG_FUNCS: dict[str, Callable[[Column, Column | None], Column]] = {
    "min": lambda c, w: F.min(_mask(c, w)),
    "max": lambda c, w: F.max(_mask(c, w)),
    "mean": lambda c, w: F.avg(_mask(c, w)),
    # pandas / R(na.rm) sum of nothing is 0, Spark's is NULL
    "sum": lambda c, w: F.coalesce(F.sum(_mask(c, w)), F.lit(0)),
    "sum_null": lambda c, w: F.sum(_mask(c, w)),
    "var": lambda c, w: F.var_samp(_mask(c, w)),
    "std": lambda c, w: F.stddev_samp(_mask(c, w)),
    "var_pop": lambda c, w: F.var_pop(_mask(c, w)),
    "count": lambda c, w: F.count(_mask(c, w)),
    "size": _size,
    "nunique": lambda c, w: F.count_distinct(_mask(c, w)),
    # for known low-cardinality columns: avoids the Expand of several distincts
    "nunique_small": lambda c, w: F.size(F.collect_set(_mask(c, w))).cast("long"),
    # of floating point values, among which NaN is one and both zeros are one
    "nunique_small_float": lambda c, w: (F.size(F.collect_set(F.when(~F.isnan(_mask(c, w)), _mask(c, w) + F.lit(0.0))))
                                         + F.coalesce(F.bool_or(F.isnan(_mask(c, w))), F.lit(False)).cast("int")).cast("long"),
    "median_approx": lambda c, w: F.percentile_approx(_mask(c, w), 0.5, 10000),
    "skew": lambda c, w: skew(_mask(c, w)),
    "kurt": lambda c, w: kurt(_mask(c, w)),
    "skew_e1071": lambda c, w: skew(_mask(c, w), "e1071"),
    "kurt_e1071": lambda c, w: kurt(_mask(c, w), "e1071"),
    "first": lambda c, w: F.first(_mask(c, w), ignorenulls=True),
}


def _exact_sum(c: Column, where: Column | None, scale: int) -> Column:
    # integer units (e.g. cents) summed as long: exact, order independent, and
    # on Spark's fast fixed-width path (a DECIMAL(38) sum is not); a group that
    # holds finer values is summed as it is
    unit = float(10 ** scale)
    x = _mask(c, where)
    units = x * F.lit(unit)
    fine = F.bool_or(F.abs(units - F.round(units)) > 1e-9 * F.greatest(F.abs(units), F.lit(1.0)))
    whole = F.sum(F.round(units).cast("long")).cast("double") / F.lit(unit)
    return F.when(F.coalesce(fine, F.lit(False)), F.sum(x)).otherwise(whole)


def _q(name: str) -> str:
    return f"`{name}`"


def _sql_stat(x: str, fn: str, where: str | None, scale: int | None) -> str | None:
    """Spark SQL text of one statistic (None when only the Column form exists)."""
    m = f"CASE WHEN {where} THEN {x} END" if where else x
    if scale is not None and fn in ("sum", "sum_null", "mean"):
        unit = repr(float(10 ** scale))
        units = f"({m} * {unit})"
        fine = f"coalesce(bool_or(abs({units} - round({units})) > 1e-9 * greatest(abs({units}), 1.0)), false)"
        total = f"CASE WHEN {fine} THEN sum({m}) ELSE CAST(sum(CAST(round({units}) AS BIGINT)) AS DOUBLE) / {unit} END"
        return {"sum": f"coalesce({total}, 0.0)", "sum_null": total, "mean": f"try_divide({total}, count({m}))"}[fn]
    n = f"CAST(count({m}) AS DOUBLE)"
    table = {
        "min": f"min({m})", "max": f"max({m})", "mean": f"avg({m})", "sum": f"coalesce(sum({m}), 0)",
        "sum_null": f"sum({m})", "var": f"var_samp({m})", "std": f"stddev_samp({m})", "var_pop": f"var_pop({m})",
        "count": f"count({m})", "size": f"count_if({where})" if where else "count(1)",
        "nunique": f"count(DISTINCT {m})", "nunique_small": f"CAST(size(collect_set({m})) AS BIGINT)",
        "median_approx": f"percentile_approx({m}, 0.5, 10000)",
        "skew": f"CASE WHEN {n} >= 3 THEN skewness({m}) * sqrt({n} * ({n} - 1)) / ({n} - 2) END",
        "kurt": f"CASE WHEN {n} >= 4 THEN ({n} - 1) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * kurtosis({m}) + 6) END",
        "skew_e1071": f"CASE WHEN {n} >= 1 THEN skewness({m}) * pow(({n} - 1) / {n}, 1.5) END",
        "kurt_e1071": f"CASE WHEN {n} >= 1 THEN (kurtosis({m}) + 3) * pow(1 - 1 / {n}, 2) - 3 END",
        "first": f"first({m}, true)",
    }
    return table.get(fn)


def agg_expr(col: str | Column, fn: str, where: Column | str | None = None, scale: int | None = None,
             name: str | None = None) -> Column:
    """One statistic.  With ``scale`` (decimal places of a currency column)
    sums and means accumulate in integer units (e.g. cents): exact, so the
    result does not depend on how rows are partitioned or merged.

    Column names with SQL-text predicates (or none) become ONE ``F.expr``
    (a single driver→JVM call); Column inputs are composed as Columns.
    """
    if isinstance(col, str) and (where is None or isinstance(where, str)):
        text = _sql_stat(_q(col), fn, where, scale)
        if text is not None:
            return F.expr(f"{text} AS {_q(name)}") if name else F.expr(text)
    c = F.col(col) if isinstance(col, str) else col
    w = F.expr(where) if isinstance(where, str) else where
    if scale is not None and fn in ("sum", "sum_null", "mean"):
        total = _exact_sum(c, w, scale)
        if fn == "sum":
            out = F.coalesce(total, F.lit(0.0))
        elif fn == "sum_null":
            out = total
        else:
            out = F.try_divide(total, F.count(_mask(c, w)))
    else:
        out = AGG_FUNCS[fn](c, w)
    return out.alias(name) if name else out


def agg_exprs(spec: Spec, prefix: str | None = None, where: Column | str | None = None,
              absent_null: bool = False, scales: Mapping[str, int] | None = None) -> list[Column]:
    """Aliased aggregate expressions for a spec.

    ``where`` restricts the rows (conditional aggregate).  With
    ``absent_null`` a group that has no row satisfying ``where`` gets NULL for
    every statistic, the same as computing the subset separately and
    left-joining it back.  ``scales`` marks currency columns (see ``agg_expr``).
    Quantiles are left out: see ``picks``.
    """
    scales = scales or {}
    out = []
    for col, fn in _pairs(spec):
        if fn in PROBS:
            continue
        name = feature_name(prefix, col, fn)
        if absent_null and where is not None:
            w = F.expr(where) if isinstance(where, str) else where
            out.append(F.when(F.count_if(w) > 0, agg_expr(col, fn, where, scales.get(col))).alias(name))
        else:
            out.append(agg_expr(col, fn, where, scales.get(col), name=name))
    return out


def picks(spec: Spec, prefix: str | None = None, where: Column | str | None = None) -> list[Pick]:
    """The quantiles of a spec, for ``select.aggregate``."""
    return [Pick(feature_name(prefix, col, fn), col, PROBS[fn], where) for col, fn in _pairs(spec) if fn in PROBS]


def agg_multi_spec(df: DataFrame, key: str | Sequence[str], spec: Spec, prefix: str | None = None,
                   where: Column | None = None, extra: Iterable[Column] = (),
                   scales: Mapping[str, int] | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Every statistic of the spec, in its order, then ``extra``; ``rows`` as in ``select.aggregate``."""
    keys = [key] if isinstance(key, str) else list(key)
    quantiles, aggs = picks(spec, prefix, where), [*agg_exprs(spec, prefix, where, scales=scales), *extra]
    named = [feature_name(prefix, col, fn) for col, fn in _pairs(spec)]
    tasks = None if quantiles or len(aggs) < WIDE else dealt_tasks(df, keys, len(aggs))
    if tasks is not None:
        floats = {c for c, t in df.dtypes if t in ("double", "float")}
        lists = [agg_expr(col, ("nunique_small_float" if col in floats else "nunique_small") if fn == "nunique" else fn, where,
                          (scales or {}).get(col), name=n) for (col, fn), n in zip(_pairs(spec), named, strict=True)]
        out = aggregate_dealt(df, keys, aggs, [*lists, *extra], tasks)
    else:
        out = aggregate(df, keys, aggs, quantiles, rows=rows)
    return out.select(*keys, *named, *[c for c in out.columns if c not in keys and c not in named])


def dealt_tasks(df: DataFrame, keys: Sequence[str], width: int) -> int | None:
    """To how many tasks the rows should be dealt by key for ``width`` statistics a group
    (0: few enough for one task, the session decides); None if there are few groups for so many rows.

    A number of its own keeps AQE from joining tasks by their shuffled bytes, which
    tell little of the buffers: rows that compress well would be joined until they spill.
    """
    n, groups = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*[F.col(_q(k)) for k in keys]))).first()
    if n > groups * GROUP_SHARE:
        return None
    tasks = max(-(-n // DEALT_ROWS), -(-groups * width // DEALT_VALUES))
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, min(session, 4 * tasks)) if tasks > 1 else 0


def aggregate_dealt(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], light: Sequence[Column], tasks: int) -> DataFrame:
    """``df.groupBy(keys).agg(aggs)`` by one shuffle of the rows of light keys.

    ``light`` gives the same columns as ``aggs`` and may gather a light group's
    values: at most a HEAVY_CUTS-th of all rows.  Rows of heavier buckets of
    keys are combined before they are moved.
    """
    heavy = F.element_at(heavy_buckets(df, keys, HEAVY_CUTS).scalar(), bucket_of(keys)).isNotNull()
    by = [F.col(_q(k)) for k in keys]
    rows = df.where(~heavy)
    dealt = (rows.repartition(tasks, *by) if tasks else rows.repartition(*by)).groupBy(*keys).agg(*light)
    return dealt.unionByName(df.where(heavy).groupBy(*keys).agg(*aggs))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and f.dataType.typeName() in
            ("double", "float", "long", "integer", "short", "byte", "decimal")]


def agg_all_columns(df: DataFrame, key: str | Sequence[str], fns: Sequence[str], prefix: str,
                    exclude: Iterable[str] = ()) -> DataFrame:
    """Every numeric column (keys excluded) × the listed statistics."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = numeric_columns(df, exclude=list(exclude) + keys)
    return agg_multi_spec(df, keys, {c: list(fns) for c in cols}, prefix)


def subset_parts(spec: Spec, subsets: Mapping[str, Column | str], ratios: Sequence[tuple[str, str]] = (),
                 ratio_prefix: str = "ratio", scales: Mapping[str, int] | None = None
                 ) -> tuple[list[Column], list[Column], list[Pick]]:
    """Aggregate expressions, post-aggregate output columns and quantiles for
    subset statistics, so callers can fuse them into a larger aggregate.

    A group with no row in a subset gets NULL for every statistic of that
    subset (as a separately aggregated subset would after a left join): one
    row count per subset is aggregated and the mask is applied after the
    aggregate, which keeps the aggregate narrow enough for codegen.
    """
    aggs, outs, masked, quantiles = [], [], {}, []
    for prefix, pred in subsets.items():
        aggs.append(F.expr(f"count_if({pred}) AS `__rows_{prefix}`") if isinstance(pred, str)
                    else F.count_if(pred).alias(f"__rows_{prefix}"))
        aggs += agg_exprs(spec, prefix, pred, scales=scales)
        quantiles += picks(spec, prefix, pred)
        for c, fn in _pairs(spec):
            n = feature_name(prefix, c, fn)
            masked[n] = F.when(F.col(f"__rows_{prefix}") > 0, F.col(n))
            outs.append(masked[n].alias(n))
    for num, den in ratios:
        for c, fn in _pairs(spec):
            outs.append(F.try_divide(masked[feature_name(num, c, fn)], masked[feature_name(den, c, fn)])
                        .alias(feature_name(f"{ratio_prefix}_{num}_{den}", c, fn)))
    return aggs, outs, quantiles


def subset_agg(df: DataFrame, key: str | Sequence[str], spec: Spec, subsets: Mapping[str, Column | str],
               ratios: Sequence[tuple[str, str]] = (), ratio_prefix: str = "ratio",
               scales: Mapping[str, int] | None = None) -> DataFrame:
    """The same spec over several row subsets in one pass, plus subset ratios
    (``{prefix: predicate}``; ``(num, den)`` prefixes, x/0 → NULL)."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs, outs, quantiles = subset_parts(spec, subsets, ratios, ratio_prefix, scales)
    return aggregate(df, keys, aggs, quantiles).select(*keys, *outs)


def two_level_agg(child: DataFrame, parent: DataFrame, child_key: str, root_key: str,
                  child_spec: Spec, child_prefix: str, parent_spec: Spec, parent_prefix: str,
                  child_scales: Mapping[str, int] | None = None,
                  parent_scales: Mapping[str, int] | None = None) -> DataFrame:
    """child → parent aggregate, left-join onto the parent, parent → root aggregate.

    The child table is pre-aggregated to one row per ``child_key`` before the
    join, so only one row per parent entity crosses the join shuffle.
    """
    child_agg = agg_multi_spec(child, child_key, child_spec, child_prefix, scales=child_scales)
    joined = parent.join(child_agg, child_key, "left")
    return agg_multi_spec(joined, root_key, parent_spec, parent_prefix, scales=parent_scales)


_SAFE = re.compile(r"[^0-9a-zA-Z]+")


def level_name(value) -> str:
    return "nan" if value is None else _SAFE.sub("_", str(value)).strip("_").lower()


def share_of_levels(df: DataFrame, key: str, col: str, levels: Sequence, prefix: str,
                    null_level: bool = True, fn: str = "mean") -> list[Column]:
    """One-hot columns averaged per group: the share of each level (``mean``)
    or its count (``sum``).  Returns aggregate expressions for ``key``."""
    def stat(ind: Column) -> Column:
        if fn == "median":
            # exact median of a 0/1 indicator from two counters: no value map
            # per group, and partial-aggregatable like a sum
            ones, n = F.sum(ind), F.count(F.lit(1))
            return F.when(ones * 2 > n, F.lit(1.0)).when(ones * 2 == n, F.lit(0.5)).otherwise(F.lit(0.0))
        return AGG_FUNCS[fn](ind, None)

    out = []
    for lv in levels:
        ind = F.coalesce((F.col(col).cast("string") == F.lit(str(lv))).cast("double"), F.lit(0.0))
        out.append(stat(ind).alias(feature_name(prefix, col, f"{level_name(lv)}_{fn}")))
    if null_level:
        ind = F.col(col).isNull().cast("double")
        out.append(stat(ind).alias(feature_name(prefix, col, f"nan_{fn}")))
    return out


def discover_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted non-null levels of several categorical columns in ONE distinct pass.

    For outputs that have one column per level, whose width the caller so
    accepts; codes of any number of levels come from ``encode.level_codes``,
    which keeps the levels in a table.
    """
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                             for c in cols])).alias("kv")
    distinct = df.select(kv).select("kv.name", "kv.value").where(F.col("value").isNotNull()).distinct()
    out: dict[str, list] = {c: [] for c in cols}
    for r in distinct.collect():
        out[r["name"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}
