"""Query registry shared by ``__spark_entry__`` and the tests.

Each registered query takes ``(spark, sf_dir)`` and returns a DataFrame over
the driver's tables.  Its oracle is an independent DuckDB query over the
same Parquet files.  Floating results are compared after rounding both sides
to the same number of significant digits with the same IEEE operations
(``round(x * 10^k) / 10^k`` with exact powers of ten), because two engines
sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.scalar import TIE_BIAS

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
PLANS: dict[str, QueryFn] = {}  # the same queries without the comparison rounding
ORACLES: dict[str, str] = {}
KINDS: dict[str, str] = {}  # name -> "sql" | "rows"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finalize(df: DataFrame, sig: int = 10, sig_cols: dict[str, int] | None = None,
             dec_cols: dict[str, int] | None = None) -> DataFrame:
    """Round every floating column to ``sig`` significant digits (``dec_cols``:
    to a fixed number of decimals instead).

    The projection is generated as SQL text and sent in one ``selectExpr``
    call: building it from Column objects costs one driver round-trip per
    function call, which dominated planning time for wide results.
    """
    sig_cols, dec_cols = sig_cols or {}, dec_cols or {}
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    # Wide results: bind each value once to a lambda variable, so upstream
    # expressions are not inlined into every reference of the rounding (which
    # can exceed the 64 KB method limit of generated code).  Narrow results
    # keep plain, fully code-generated expressions.
    wide = len(floats) > 24
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        x = "v" if wide else f"CAST({q} AS DOUBLE)"
        if f.name in dec_cols:
            e = _spark_dec(x, dec_cols[f.name])
        elif f.name in floats:
            e = _spark_sig(x, sig_cols.get(f.name, sig))
        else:
            exprs.append(q)
            continue
        exprs.append(f"transform(array(CAST({q} AS DOUBLE)), v -> {e})[0] AS {q}" if wide else f"{e} AS {q}")
    return df.selectExpr(*exprs)


def _spark_sig(x: str, sig: int) -> str:
    # same arithmetic as functions.scalar.sig_round, as Spark SQL text
    k = f"({sig - 1} - floor(log10(abs({x}))))"
    y = f"({x} * {1.0 + TIE_BIAS!r})"
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR {x} IN (double('inf'), double('-inf')) THEN {x} "
            f"WHEN {k} >= 0 THEN round({y} * pow(10.0, {k})) / pow(10.0, {k}) "
            f"ELSE round({y} / pow(10.0, -{k})) * pow(10.0, -{k}) END")


def _spark_dec(x: str, decimals: int) -> str:
    p = repr(float(10 ** decimals))
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} ELSE round({x} * {1.0 + TIE_BIAS!r} * {p}) / {p} END"


_BIAS = "(1 + pow(2, -40))"


def _sql_round(x: str, sig: int) -> str:
    k = f"({sig - 1} - floor(log10(abs({x}))))"
    y = f"({x} * {_BIAS})"
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
            f"WHEN {k} >= 0 THEN round({y} * pow(10, {k})) / pow(10, {k}) "
            f"ELSE round({y} / pow(10, -{k})) * pow(10, -{k}) END")


def _sql_dec(x: str, decimals: int) -> str:
    p = f"{float(10 ** decimals)!r}"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} ELSE round({x} * {_BIAS} * {p}) / {p} END"


def _quoted(cols: Sequence[str]) -> str:
    return ", ".join("'" + c + "'" for c in cols)


def oracle_wrap(inner: str, exact: Sequence[str], sig: int = 10, sig_cols: dict[str, int] | None = None,
                dec_cols: dict[str, int] | None = None) -> str:
    """Wrap an oracle query so its floating columns are rounded like ``finalize``.

    ``exact`` lists the non-floating output columns (keys, counts, labels).
    """
    sig_cols, dec_cols = sig_cols or {}, dec_cols or {}
    parts = []
    if exact:
        parts.append(f"COLUMNS(lambda c: c IN ({_quoted(exact)}))")
    special = list(sig_cols) + list(dec_cols)
    rest_excl = list(exact) + special
    rest = f"COLUMNS(* EXCLUDE ({', '.join(rest_excl)}))" if rest_excl else "COLUMNS(*)"
    parts.append(_sql_round(rest, sig))
    for c, s in sig_cols.items():
        parts.append(f"{_sql_round(c, s)} AS {c}")
    for c, s in dec_cols.items():
        parts.append(f"{_sql_dec(c, s)} AS {c}")
    return f"SELECT {', '.join(parts)} FROM ({inner}) AS oracle_inner"


def register(name: str, sql: str | None = None, exact: Sequence[str] = (), sig: int = 10,
             sig_cols: dict[str, int] | None = None, all_exact: bool = False,
             dec_cols: dict[str, int] | None = None):
    """Register a query; with ``sql`` it gets a DuckDB oracle.

    ``all_exact`` marks an oracle with no floating output column at all.
    """
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir), sig, sig_cols, dec_cols)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        PLANS[name] = fn
        KINDS[name] = "sql" if sql is not None else "rows"
        if sql is not None:
            ORACLES[name] = sql if all_exact else oracle_wrap(sql, exact, sig, sig_cols, dec_cols)
        return fn
    return deco
