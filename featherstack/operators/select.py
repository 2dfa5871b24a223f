"""Exact quantiles of groups beside ordinary aggregates, for groups of any size.

Two ways, by the size of a group:

* A group of at most ``limit`` rows keeps its values in one list, sorted inside
  the aggregate that computes the other statistics: one shuffle for all, and a
  bounded list.
* A larger group is never gathered.  Its quantiles are found by radix
  selection: every value has an order-preserving 64-bit key, and four passes
  count (group, statistic, 16-bit digit) map-side.  A pass keeps, for each
  wanted rank, the digit that holds it and the rank inside that digit, so the
  next pass reads only values that agree with the digits so far.  All
  quantiles of all columns share the passes; a pass ships at most 65,536 rows a
  statistic from a task, and neither a window, a sort nor a map of values ever
  holds a group.

Quantiles interpolate linearly between the two nearest ranks (numpy, pandas);
NULLs don't count, and a group without values has NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

GROUP_ROWS = 100_000  # rows whose values may be one list
DIGIT_BITS = 16
PROBS = {"median": (0.5,), "q25": (0.25,), "q75": (0.75,), "iqr": (0.25, 0.75)}


@dataclass(frozen=True)
class Pick:
    """A quantile of ``column`` (or the difference of two) among the rows that satisfy ``where``."""
    name: str
    column: str
    probs: tuple[float, ...]
    where: Column | str | None = None


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _is(a: Column | str | None, b: Column | str | None) -> bool:
    """Whether two predicates are the same one."""
    return a is b or (isinstance(a, str) and isinstance(b, str) and a == b)


def _predicate(where: Column | str) -> Column:
    return F.expr(where) if isinstance(where, str) else where


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the left side's keys stay."""
    named = right.select(*[F.col(f"`{k}`").alias(f"__r_{k}") for k in keys], *[f"`{c}`" for c in right.columns if c not in keys])
    on = [left[f"`{k}`"].eqNullSafe(named[f"`__r_{k}`"]) for k in keys]
    return left.join(named, on, how).drop(*[f"__r_{k}" for k in keys])


def aggregate(df: DataFrame, keys: str | Sequence[str], aggs: Sequence[Column], picks: Sequence[Pick],
              limit: int = GROUP_ROWS, rows: DataFrame | None = None) -> DataFrame:
    """``df.groupBy(keys).agg(aggs)`` with the quantiles ``picks``.

    ``rows`` may name a cheaper frame with as many rows of each group as
    ``df``, from which the sizes are counted.
    """
    keys = _keys(keys)
    if not picks:
        return df.groupBy(*keys).agg(*aggs)
    sizes = (df if rows is None else rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    if (sizes.agg(F.max("__size")).first()[0] or 0) <= limit:
        return _listed(df, keys, aggs, picks)
    large = materialize(sizes.where(F.col("__size") > limit).drop("__size"))  # at most one row for each ``limit`` rows
    light = _listed(_same(df, large, keys, "left_anti"), keys, aggs, picks)
    heavy = _same(df, large, keys, "left_semi")
    found = radix_quantiles(heavy, keys, picks)
    plain = heavy.groupBy(*keys).agg(*aggs) if aggs else heavy.select(*keys).distinct()
    return light.unionByName(_same(plain, found, keys, "left").select(*light.columns))


# ---------------------------------------------------------------- small groups
def _listed(df: DataFrame, keys: list[str], aggs: Sequence[Column], picks: Sequence[Pick]) -> DataFrame:
    """Quantiles read off sorted lists of each group's values; the rows are
    dealt once by key, and all statistics are computed where they land."""
    columns = list(dict.fromkeys(p.column for p in picks))
    masks: list[Column | str] = []
    for p in picks:
        if p.where is not None and not any(_is(p.where, m) for m in masks):
            masks.append(p.where)
    fields = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    fields += [_predicate(m).alias(f"m{i}") for i, m in enumerate(masks)]
    dealt = df.repartition(*[F.col(f"`{k}`") for k in keys])
    out = dealt.groupBy(*keys).agg(*aggs, F.collect_list(F.struct(*fields)).alias("__rows"))
    lists: dict[tuple, str] = {}
    exprs = []
    for p in picks:
        v = f"v{columns.index(p.column)}"
        m = next((f"m{i}" for i, x in enumerate(masks) if _is(x, p.where)), None) if p.where is not None else None
        name = lists.setdefault((v, m), f"__list{len(lists)}")
        exprs.append(F.expr(f"{' - '.join(_read(name, q) for q in reversed(p.probs))} AS `{p.name}`"))
    # no element is NULL, and the type says so: an array of primitives is sorted, without a comparator that is called for each pair
    sorted_lists = [f"sort_array(transform(filter(__rows, r -> r.{v} IS NOT NULL{f' AND r.{m}' if m else ''}), r -> coalesce(r.{v}, 0.0D))) AS {name}"
                    for (v, m), name in lists.items()]
    named = [c for c in out.columns if c != "__rows"]
    return out.selectExpr(*[f"`{c}`" for c in named], *sorted_lists).select(*[f"`{c}`" for c in named], *exprs)


def _read(values: str, q: float) -> str:
    """SQL for the quantile of a sorted array."""
    at = f"((size({values}) - 1) * {q!r}D)"
    low, high = f"get({values}, CAST(floor{at} AS INT))", f"get({values}, CAST(ceil{at} AS INT))"
    return f"({low} + ({high} - {low}) * ({at} - floor{at}))"


# ---------------------------------------------------------------- large groups
def ordered_key(value: Column) -> Column:
    """A long that orders as the double ``value`` does (both zeros are one)."""
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))


def _digit(key: Column, place: int) -> Column:
    """The ``place``-th digit from the top; the first carries the sign."""
    shifted = F.shiftright(key, 64 - DIGIT_BITS * (place + 1))
    return shifted if place == 0 else shifted.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def radix_quantiles(df: DataFrame, keys: str | Sequence[str], picks: Sequence[Pick]) -> DataFrame:
    """(keys…, one column for each pick) by radix selection."""
    keys = _keys(keys)
    parts: list[tuple[str, Column | str | None]] = []
    for p in picks:
        if not any(p.column == c and _is(p.where, w) for c, w in parts):
            parts.append((p.column, p.where))
    which = {p.name: next(i for i, (c, w) in enumerate(parts) if p.column == c and _is(p.where, w)) for p in picks}
    values = [F.struct(F.lit(i).alias("__s"), (F.col(f"`{c}`") if w is None else F.when(_predicate(w), F.col(f"`{c}`"))).cast("double").alias("__v"))
              for i, (c, w) in enumerate(parts)]
    long = df.select(*keys, F.explode(F.array(*values)).alias("__kv")).select(*keys, "__kv.*").where("__v IS NOT NULL")
    long = materialize(long.withColumn("__key", ordered_key(F.col("__v"))))
    by = [*keys, "__s"]
    totals = long.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    probs = {i: sorted({q for p in picks if which[p.name] == i for q in p.probs}) for i in range(len(parts))}
    wanted = F.array(*[F.struct(F.lit(i).alias("s"), F.lit(q).alias("q")) for i, qs in probs.items() for q in qs])
    at = totals.select("*", F.explode(wanted).alias("__w")).where("__w.s = __s").withColumn("__at", (F.col("__n") - 1) * F.col("__w.q"))
    targets = at.select(*by, F.col("__w.q").alias("__q"), F.explode(F.array(F.floor("__at"), F.ceil("__at"))).alias("__rank"))
    # a target: the rank that is left to find among the values that begin with ``__prefix``
    targets = targets.distinct().select(*by, "__q", F.col("__rank").alias("__first"), F.col("__rank").alias("__left"), F.lit(0).cast("long").alias("__prefix"))
    for place in range(64 // DIGIT_BITS):
        targets = materialize(_narrow(long, targets, by, place))
    found = targets.groupBy(*by, "__q").agg(F.min_by("__value", "__first").alias("__lo"), F.max_by("__value", "__first").alias("__hi"))
    share = _same(found, totals, by, "inner").withColumn("__at", (F.col("__n") - 1) * F.col("__q"))
    share = share.withColumn("__x", F.expr("__lo + (__hi - __lo) * (__at - floor(__at))"))

    def value(i: int, q: float) -> Column:
        return F.max(F.when((F.col("__s") == i) & (F.col("__q") == F.lit(q)), F.col("__x")))
    columns = []
    for p in picks:
        parts_of = [value(which[p.name], q) for q in p.probs]
        columns.append((parts_of[0] if len(parts_of) == 1 else parts_of[1] - parts_of[0]).alias(p.name))
    return share.groupBy(*keys).agg(*columns)


def _narrow(long: DataFrame, targets: DataFrame, by: list[str], place: int) -> DataFrame:
    """Targets with one more digit: count the digits of the values that agree
    with the digits so far, and take the one that holds the rank."""
    begin = F.lit(0).cast("long") if place == 0 else F.shiftright(F.col("__key"), 64 - DIGIT_BITS * place)
    rows = long.withColumn("__begin", begin)
    if place:
        alive = targets.select(*by, F.col("__prefix").alias("__begin")).distinct()
        rows = _same(rows, alive, [*by, "__begin"], "left_semi")
    digits = rows.groupBy(*by, "__begin", _digit(F.col("__key"), place).alias("__digit")).agg(
        F.count(F.lit(1)).alias("__count"), F.max("__v").alias("__value"))
    before = Window.partitionBy(*by, "__begin").orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)  # at most 65,536 rows
    digits = digits.withColumn("__before", F.coalesce(F.sum("__count").over(before), F.lit(0)))
    same = _same(targets.drop("__value").withColumnRenamed("__prefix", "__begin"), digits, [*by, "__begin"], "inner")
    hit = same.where("__before <= __left AND __left < __before + __count")
    prefix = F.shiftleft("__begin", DIGIT_BITS) + F.col("__digit") if place else F.col("__digit")
    return hit.select(*by, "__q", "__first", (F.col("__left") - F.col("__before")).alias("__left"), prefix.alias("__prefix"), "__value")
