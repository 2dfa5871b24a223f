"""Exact group quantiles: lists of small groups and radix selection of large ones against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherstack.operators import agg as A
from featherstack.operators import select as S
from featherstack.operators.select import Pick
from sf_paths import SF_SMALL

def picks():
    return [Pick("x_median", "x", (0.5,)), Pick("x_iqr", "x", (0.25, 0.75)), Pick("y_median", "y", (0.5,), "m"),
            Pick("nothing", "x", (0.5,), "y > 100"), Pick("x_q75_m", "x", (0.75,), F.col("m"))]


def rows(n=4000, seed=3):
    rng = random.Random(seed)
    values = [None, 0.0, -0.0, 1.5, -3.25, 1e300, -1e-300, 5e-324, -1.7e308]
    return [("hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c"]), rng.choice([*values, float(i), rng.gauss(0, 1), rng.gauss(0, 1)]),
             i % 7, i % 4 == 0) for i in range(n)]


def quantile(values, q):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    at = (len(v) - 1) * q
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    return lo + (hi - lo) * (at - math.floor(at))


def expected(data):
    out = {}
    for key in {r[0] for r in data}:
        g = [r for r in data if r[0] == key]
        x, xm = [r[1] for r in g], [r[1] for r in g if r[3]]
        out[key] = {"n": len(g), "x_median": quantile(x, 0.5), "x_iqr": quantile(x, 0.75) - quantile(x, 0.25),
                    "y_median": quantile([float(r[2]) for r in g if r[3]], 0.5), "nothing": None, "x_q75_m": quantile(xm, 0.75)}
    return out


@pytest.mark.parametrize("limit", [100_000, 1200, 10])  # all in lists; the hot group by radix; every group by radix
def test_quantiles_against_sorting(spark, limit):
    data = rows()
    df = spark.createDataFrame(data, "k string, x double, y int, m boolean").repartition(5)
    got = {r["k"]: r.asDict() for r in S.aggregate(df, "k", [F.count(F.lit(1)).alias("n")], picks(), limit=limit).collect()}
    for key, want in expected(data).items():
        for name, value in want.items():
            assert got[key][name] == (pytest.approx(value, rel=1e-12) if value is not None else None), (key, name)


def test_radix_passes_hold_no_group(spark):
    """A key with a third of the rows: no list, no sort and no map of its values."""
    df = spark.createDataFrame(rows(), "k string, x double, y int, m boolean")
    plan = S.radix_quantiles(df, ["k"], picks())._jdf.queryExecution().toString().lower()
    assert not any(w in plan for w in ("percentile", "collect_list", "median("))


def test_keys_keep_the_order_of_doubles(spark):
    values = [-math.inf, -1.7e308, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1.7e308, math.inf]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    keys = [r["k"] for r in df.select("i", S.ordered_key(F.col("v")).alias("k")).orderBy("i").collect()]
    assert all((a < b) == (x < y) for a, b, x, y in zip(keys, keys[1:], values, values[1:], strict=False))


def test_several_keys_and_an_empty_table(spark):
    df = spark.createDataFrame([(i % 3, None if i % 2 else "z", float(i)) for i in range(60)], "a int, b string, x double")
    for limit in (1000, 5):
        got = {(r["a"], r["b"]): r["m"] for r in S.aggregate(df, ["a", "b"], [], [Pick("m", "x", (0.5,))], limit=limit).collect()}
        assert got == {(a, b): np.median([i for i in range(60) if i % 3 == a and (i % 2 == 1) == (b is None)]) for a in range(3) for b in (None, "z")}
    assert S.aggregate(df.limit(0), ["a"], [], [Pick("m", "x", (0.5,))]).count() == 0


@pytest.mark.parametrize("name", ["agg_multi_spec", "summarise_shape", "features_bureau_two_level", "features_installments", "customer_history_features"])
def test_no_value_maps_in_plans(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "median(" not in plan


def test_spec_keeps_its_order(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0)], "k int, x double")
    out = A.agg_multi_spec(df, "k", {"x": ["min", "median", "max", "iqr"]}, "p", extra=[F.count(F.lit(1)).alias("size")])
    assert out.columns == ["k", "p_x_min", "p_x_median", "p_x_max", "p_x_iqr", "size"]
    assert tuple(out.first()) == (1, 2.0, 3.0, 4.0, 1.0, 2)
