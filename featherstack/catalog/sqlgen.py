"""DuckDB spellings of the aggregate statistics, for writing oracles.

These are SQL texts evaluated by DuckDB's own engine; they restate the
semantics of §1.1 (sum of nothing = 0, corrected skew/kurtosis, sample
variance) in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def _f(where: str | None) -> str:
    return f" FILTER (WHERE {where})" if where else ""


def agg(col: str, fn: str, where: str | None = None, scale: int | None = None) -> str:
    fw = _f(where)
    if scale is not None and fn in ("sum", "mean", "sum_null"):
        unit = repr(float(10 ** scale))
        total = f"(CAST(sum(CAST(round({col} * {unit}) AS BIGINT)){fw} AS DOUBLE) / {unit})"
        if fn == "sum":
            return f"coalesce({total}, 0)"
        if fn == "sum_null":
            return total
        return f"{total} / nullif(count({col}){fw}, 0)"
    return {
        "min": f"min({col}){fw}",
        "max": f"max({col}){fw}",
        "mean": f"avg({col}){fw}",
        "sum": f"coalesce(sum({col}){fw}, 0)",
        "sum_null": f"sum({col}){fw}",
        "var": f"var_samp({col}){fw}",
        "std": f"stddev_samp({col}){fw}",
        "var_pop": f"var_pop({col}){fw}",
        "count": f"count({col}){fw}",
        "size": f"count(*){fw}",
        "nunique": f"count(DISTINCT {col}){fw}",
        "nunique_small": f"count(DISTINCT {col}){fw}",
        "median": f"median({col}){fw}",
        "iqr": f"(quantile_cont({col}, 0.75){fw} - quantile_cont({col}, 0.25){fw})",
        "skew": f"skewness({col}){fw}",
        "kurt": f"kurtosis({col}){fw}",
    }[fn]


def spec_sql(spec: Mapping[str, Sequence[str]], prefix: str | None, where: str | None = None,
             absent_null: bool = False, scales: Mapping[str, int] | None = None,
             int_sums: Sequence[str] = ()) -> list[str]:
    """``expr AS name`` items for a spec (names as ``feature_name``)."""
    scales = scales or {}
    out = []
    for col, fns in spec.items():
        for fn in fns:
            e = agg(col, fn, where, scales.get(col))
            if fn == "sum" and col in int_sums:
                e = f"CAST({e} AS BIGINT)"
            if absent_null and where:
                e = f"CASE WHEN count(*) FILTER (WHERE {where}) > 0 THEN {e} END"
            name = "_".join(p for p in (prefix, col, fn) if p).lower()
            out.append(f"{e} AS {name}")
    return out


def names(spec: Mapping[str, Sequence[str]], prefix: str | None) -> list[str]:
    return ["_".join(p for p in (prefix, c, fn) if p).lower() for c, fns in spec.items() for fn in fns]
