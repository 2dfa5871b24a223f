"""Literal-row tests for the numeric and missing-value rules (SURVEY §1.1,
FIXTURES part C)."""

import math

import pytest
from pyspark.sql import functions as F

from featherstack.functions import clean, rowstats, scalar
from featherstack.operators import agg as A
from featherstack.operators import bins as Bn
from featherstack.operators import encode as En
from featherstack.operators import groupstats as G
from featherstack.operators import metrics as M
from featherstack.operators import ordered as O
from featherstack.operators import rank as R


def approx(a, b, tol=1e-8):
    return a is not None and abs(a - b) <= tol * max(1.0, abs(b))


@pytest.fixture
def moments5(spark):
    return spark.createDataFrame([(1, float(x), float(y)) for x, y in zip([1, 2, 3, 4, 5], [1, 2, 7, 9, 30])],
                                 "k int, x double, y double")


def test_moments_corrected_and_population(spark, moments5):
    r = moments5.groupBy("k").agg(*A.agg_exprs({"y": ["skew", "kurt", "var"]}, "m"),
                                  F.skewness("y").alias("g1"), F.kurtosis("y").alias("g2")).first()
    assert approx(r["m_y_skew"], 1.8018549983)
    assert approx(r["g1"], 1.2087210785)
    assert approx(r["m_y_kurt"], 3.4525818848)
    assert approx(r["g2"], -0.1368545288)
    assert approx(r["m_y_var"], 138.7)


def test_line_fit_and_quantile(spark, moments5):
    t = O.trend_fit(moments5, "k", "y", "x", "t").first()
    assert approx(t["t_y_slope"], 6.5) and approx(t["t_y_intercept"], -9.7)
    q = R.global_quantiles(moments5, ["x"], [0.05])["x"][0]
    assert approx(q, 1.2)


def test_singleton_group(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0)], "k int, x double, y double")
    r = df.groupBy("k").agg(*A.agg_exprs({"y": ["std", "skew", "kurt"]}, "s")).first()
    assert r["s_y_std"] is None and r["s_y_skew"] is None and r["s_y_kurt"] is None
    t = O.trend_fit(df, "k", "y", "x", "t").first()
    assert t["t_y_slope"] is None and approx(t["t_y_intercept"], 5.0)


def test_all_null_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k int, v double")
    r = {row["k"]: row for row in A.agg_multi_spec(df, "k", {"v": ["sum", "mean", "min", "max", "count", "size"]}, "a").collect()}
    assert r[1]["a_v_sum"] == 0 and r[1]["a_v_mean"] is None and r[1]["a_v_min"] is None
    assert r[1]["a_v_count"] == 0 and r[1]["a_v_size"] == 2


def test_zero_denominator_no_error(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (4.0, 2.0)], "a double, b double")
    out = [r[0] for r in df.select(scalar.safe_div("a", "b")).collect()]
    assert out[:2] == [None, None] and out[2] == 2.0
    zero = [r[0] for r in df.select(scalar.safe_div_zero("a", "b")).collect()]
    assert zero == [0.0, 0.0, 2.0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 2.0)], "k int, v double")
    r = A.agg_multi_spec(clean.nan_to_null(df), "k", {"v": ["mean", "count"]}, "a").first()
    assert r["a_v_mean"] == 2.0 and r["a_v_count"] == 1


def test_ties_at_max(spark):
    df = spark.createDataFrame([(1, 10, 100), (1, 10, 101), (1, 5, 102)], "k int, t int, child int")
    assert O.extreme_rows(df, "k", "t").count() == 2
    assert O.last_values(df, "k", ["t", "child"], ["child"], "x").first()[1] == 101


def test_null_key_gets_no_group_statistic(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    out = {r["v"]: r for r in G.group_recipes(df, [(["g"], [("v", "mean")])]).collect()}
    assert out[1.0]["grp_g_v_mean"] is None and out[5.0]["grp_g_v_mean"] == 5.0


def test_rank_ties(spark):
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate([1, 1, 2, 3])], "id int, s double")
    mins = {r["id"]: r["s_rank"] for r in R.rank_columns(df, ["s"], "min").collect()}
    avgs = {r["id"]: r["s_rank"] for r in R.rank_columns(df, ["s"], "average").collect()}
    assert [mins[i] for i in range(4)] == [1, 1, 3, 4]
    assert [avgs[i] for i in range(4)] == [1.5, 1.5, 3, 4]


def test_auc_ties(spark):
    df = spark.createDataFrame([(2.0, 1), (3.0, 1), (1.0, 0), (2.0, 0)], "s double, y int")
    assert approx(M.auc(df, "s", "y").first()["auc"], 0.875)


def test_qcut_duplicate_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + [2, 3, 4]], "x double")
    edges = Bn.fit_edges(df, ["x"], 10)["x"]
    assert len(edges) < 11 and edges == sorted(set(edges))
    bins = {r[0] for r in df.select(Bn.quantile_bin("x", edges)).collect()}
    assert len(bins) <= len(edges) - 1


def test_missing_level_encodings(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    levels = En.fit_levels(df, ["c"])["c"]
    assert levels == ["a", "b"]
    coded = En.factorize_code(En.factor_code(En.label_encode(df.withColumn("o", F.lit(1)), "c", "lab"), "c", "fac"), "c", "o", "fz")
    missing = coded.select("*", *En.one_hot("c", levels, null_level=True)).where("c IS NULL").first()
    assert missing["c_nan"] == 1 and missing["lab"] == 2 and missing["fac"] is None and missing["fz"] == -1


def test_row_stats_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0)], "a double, b double, c double")
    r = df.select(*rowstats.row_stats(["a", "b", "c"], ["mean", "sum", "median", "missing", "std"], "r")).first()
    assert r["r_mean"] == 2.0 and r["r_sum"] == 4.0 and r["r_median"] == 2.0 and r["r_missing"] == 1
    assert approx(r["r_std"], math.sqrt(2.0))


def test_positive_part_null_rules(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (3.0,)], "x double")
    py = [r[0] for r in df.select(scalar.positive_part("x")).collect()]
    rr = [r[0] for r in df.select(scalar.positive_part("x", keep_null=True)).collect()]
    assert py == [0.0, 0.0, 3.0] and rr == [None, 0.0, 3.0]


def test_cluster_conf_scales_partitions():
    from featherstack.session import cluster_conf
    small = cluster_conf(10 << 30, 4, 10)
    big = cluster_conf(100 << 40, 8, 1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of 40 cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
