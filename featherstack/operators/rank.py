"""Distributed ranks, cumulative counts and exact quantiles.

A global rank written as an un-partitioned window pulls every row into one
task.  Here:

1. rows are aggregated to distinct ``(group, value)`` with counts (and any
   extra weights, e.g. positives/negatives) — a hot value becomes one row;
2. each group's distinct values are cut into value-range buckets at
   approximate quantile edges.  The edges are a table, one row per group, with
   as many buckets as the group's own rows need (~2M rows per bucket), so a
   bucket window stays bounded at any scale and any number of groups will do;
   a value finds its bucket by binary search;
3. a running sum is taken inside each ``(group, bucket)`` window;
4. bucket totals (a ``groups × buckets`` table) get exclusive prefix sums and
   are joined back by (group, bucket).

The result is exact.  Ranks, quantiles with linear interpolation and the
tie-aware AUC are all read off these cumulative counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

DEFAULT_BUCKETS = 64  # for groups of many rows, so that several tasks share them
ROWS_PER_BUCKET = 2_000_000
LEAST_ROWS = 10_000  # rows that make a bucket worth its task


def _edges(base: DataFrame, by: list[str], v: str, buckets: int | None) -> DataFrame:
    """(by…, __edges): sorted, distinct bucket edges of each group.

    One number reaches the driver, the largest group's size, which sets how fine
    the quantile sketch must be; the edges stay a table, written once so that
    every retry cuts at the same places.
    """
    if buckets is None:
        largest = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        grid = max(DEFAULT_BUCKETS, math.ceil(largest / ROWS_PER_BUCKET))
        rows = F.count(F.lit(1))
        wanted = F.greatest(F.ceil(rows / ROWS_PER_BUCKET), F.least(F.lit(DEFAULT_BUCKETS), F.ceil(rows / LEAST_ROWS)))
    else:
        grid, wanted = buckets, F.max(F.lit(buckets))
    probs = [i / grid for i in range(1, grid)]
    sketch = base.groupBy(*by).agg(F.percentile_approx(v, probs, max(100, 10 * grid)).alias("__all") if probs
                                   else F.max(F.array().cast("array<double>")).alias("__all"), wanted.cast("int").alias("__w"))
    # every (grid / wanted)-th edge of the sketch
    picked = F.filter("__all", lambda e, i: F.floor((i + 1) * F.col("__w") / grid) > F.floor(i * F.col("__w") / grid))
    return materialize(sketch.select(*by, F.array_sort(F.array_distinct(picked)).alias("__edges")))


def positions_up_to(edges: Column, value: Column) -> Column:
    """How many of the sorted ``edges`` are at most ``value``, by binary search."""
    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = F.get(edges, mid) <= value
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
                                                               F.when(right, s["hi"]).otherwise(mid).alias("hi")))
    span = F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(edges) + F.lit(1))).cast("int"))
    return F.aggregate(steps, span, halve, lambda s: s["lo"])


def cumulative_counts(df: DataFrame, value: str | Column, by: Sequence[str] = (),
                      weights: Mapping[str, Column] | None = None, buckets: int | None = None) -> DataFrame:
    """Distinct non-null values per group with exact running counts.

    Output columns: ``by…, __v, __n`` (rows with this value), ``__before``
    (rows with a smaller value), ``__dense_before`` (distinct smaller values),
    ``__total`` (non-null rows in the group) and for each weight ``w``:
    ``w`` (sum at this value), ``w__before`` and ``w__total``.
    """
    by = list(by)
    weights = dict(weights or {})
    v = F.col(value) if isinstance(value, str) else value
    base = df.select(*by, v.cast("double").alias("__v"), *[c.alias(k) for k, c in weights.items()]) \
        .where(F.col("__v").isNotNull())
    # any edges give exact results; without groups a constant stands for the one group
    keys = by or ["__all_rows"]
    base = base if by else base.withColumn("__all_rows", F.lit(0))
    edges = _edges(base, keys, "__v", buckets)
    vc = base.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(k).alias(k) for k in weights])
    if not by:  # one row of edges: a constant of the plan
        one = edges.first()
        vc = vc.withColumn("__edges", F.array(*[F.lit(float(x)) for x in (one["__edges"] if one else ()) or ()]).cast("array<double>"))
    else:
        named = edges.select(*[F.col(k).alias(f"__e_{k}") for k in keys], "__edges")
        vc = vc.join(named, [F.col(k).eqNullSafe(F.col(f"__e_{k}")) for k in keys], "left").drop(*[f"__e_{k}" for k in keys])
    vc = vc.withColumn("__b", F.coalesce(positions_up_to(F.col("__edges"), F.col("__v")), F.lit(0))).drop("__edges")
    by_out, by = by, keys

    cum_names = ["__n", "__d"] + list(weights)
    vc = vc.withColumn("__d", F.lit(1))
    w_in = Window.partitionBy(*by, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    for c in cum_names:
        vc = vc.withColumn(f"{c}__in", F.coalesce(F.sum(c).over(w_in), F.lit(0)))

    totals = vc.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"{c}__bt") for c in cum_names])
    w_off = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # rows: buckets
    w_all = Window.partitionBy(*by)
    totals = totals.select(*[F.col(k).alias(f"__t_{k}") for k in by], F.col("__b").alias("__t_b"),
                           *[F.coalesce(F.sum(f"{c}__bt").over(w_off), F.lit(0)).alias(f"{c}__off") for c in cum_names],
                           *[F.sum(f"{c}__bt").over(w_all).alias(f"{c}__tot") for c in cum_names])
    j = vc.join(totals, [F.col("__b") == F.col("__t_b"), *[F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in by]], "inner")
    out = [*by_out, "__v", "__n",
           (F.col("__n__off") + F.col("__n__in")).alias("__before"),
           (F.col("__d__off") + F.col("__d__in")).alias("__dense_before"),
           F.col("__n__tot").alias("__total")]
    for k in weights:
        out += [F.col(k), (F.col(f"{k}__off") + F.col(f"{k}__in")).alias(f"{k}__before"),
                F.col(f"{k}__tot").alias(f"{k}__total")]
    return j.select(*out)


RANK_METHODS = ("min", "max", "average", "dense")


def rank_expr(method: str) -> Column:
    if method == "min":
        return (F.col("__before") + 1).cast("double")
    if method == "max":
        return (F.col("__before") + F.col("__n")).cast("double")
    if method == "average":
        return F.col("__before") + (F.col("__n") + 1) / 2.0
    if method == "dense":
        return (F.col("__dense_before") + 1).cast("double")
    raise ValueError(method)


def melt(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep…, __name, __x)``: one row for each of ``cols``, as doubles."""
    each = F.array(*[F.struct(F.lit(c).alias("__name"), F.col(c).cast("double").alias("__x")) for c in cols])
    return df.select(*keep, F.explode(each).alias("__kv")).select(*keep, "__kv.*")


def ranks_of(melted: DataFrame, method: str, by: Sequence[str] = (), pct: bool = False, buckets: int | None = None) -> DataFrame:
    """``(__of_<by>…, __of_name, __v, __r)``: the rank of every distinct value of each melted column."""
    cc = cumulative_counts(melted, "__x", [*by, "__name"], buckets=buckets)
    r = rank_expr(method) / F.col("__total") if pct else rank_expr(method)
    return cc.select(*[F.col(c).alias(f"__of_{c}") for c in by], F.col("__name").alias("__of_name"), "__v", r.alias("__r"))


def rank_columns(df: DataFrame, cols: Sequence[str], method: str = "average", by: Sequence[str] = (),
                 suffix: str = "_rank", pct: bool = False, buckets: int | None = None) -> DataFrame:
    """Ranks of several columns at once: the columns are melted to
    ``(name, value)`` so one set of shuffles ranks all of them; each rank is
    joined back on ``(group, value)``.  NULL values get a NULL rank."""
    by = list(by)
    ranks = ranks_of(melt(df, cols, by), method, by, pct, buckets)
    out = df
    for c in cols:
        rc = ranks.where(F.col("__of_name") == c).drop("__of_name").withColumnRenamed("__r", c + suffix)
        cond = [F.col(c).cast("double") == F.col("__v")] + [F.col(b).eqNullSafe(F.col(f"__of_{b}")) for b in by]
        out = out.join(rc, cond, "left").drop("__v", *[f"__of_{b}" for b in by])
    return out


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default,
    DuckDB ``quantile_cont``) of several columns, per group, in long form:
    ``by…, __name, __i, __q`` (``__i`` indexes ``probs``).

    Each distinct value emits only the quantile positions it covers, so the
    read-out costs one small aggregate whatever the number of probabilities.
    """
    by = list(by)
    cc = cumulative_counts(melt(df, cols, by), "__x", by + ["__name"], buckets=buckets)
    probs_arr = F.array(*[F.lit(float(q)) for q in probs])
    pos = F.transform(probs_arr, lambda q, i: F.struct(i.alias("i"), ((F.col("__total") - 1) * q).alias("p")))
    lo_end = F.col("__before") + F.col("__n")

    def covers(s):
        return ((F.col("__before") <= F.floor(s["p"])) & (F.floor(s["p"]) < lo_end)) | \
               ((F.col("__before") <= F.ceil(s["p"])) & (F.ceil(s["p"]) < lo_end))

    hits = cc.select(*by, "__name", "__v", "__before", "__n", F.explode(F.filter(pos, covers)).alias("__s"))
    lo, hi = F.floor(F.col("__s.p")), F.ceil(F.col("__s.p"))
    agg = hits.groupBy(*by, "__name", F.col("__s.i").alias("__i")).agg(
        F.max(F.when((F.col("__before") <= lo) & (lo < F.col("__before") + F.col("__n")), F.col("__v"))).alias("__lo"),
        F.max(F.when((F.col("__before") <= hi) & (hi < F.col("__before") + F.col("__n")), F.col("__v"))).alias("__hi"),
        F.max(F.col("__s.p") - lo).alias("__d"))
    return agg.select(*by, "__name", "__i", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__d")).alias("__q"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """As ``quantiles_long`` with one column ``q_<i>`` per probability."""
    by = list(by)
    long = quantiles_long(df, cols, probs, by, buckets)
    return long.groupBy(*by, "__name").agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"q_{i}")
                                              for i in range(len(probs))])


def global_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact global quantiles returned to the driver (columns × probs numbers)."""
    out = {c: [None] * len(probs) for c in cols}
    for r in quantiles_long(df, cols, probs).collect():
        out[r["__name"]][r["__i"]] = r["__q"]
    return out
