"""Wide aggregates over many small groups: rows dealt by key instead of wide buffers."""

import math

from pyspark.sql import functions as F

from featherstack.operators import agg as A


def test_wide_spec_over_small_groups_deals_rows(spark):
    nan = float("nan")
    rows = [(i // 3 if i % 4 else None, [0.0, -0.0, nan, None, float(i % 5)][i % 5], i % 7, f"s{i % 2}") for i in range(9000)]
    rows += [(-1, float(i % 100), i, "h") for i in range(3000)]  # a heavy key
    df = spark.createDataFrame(rows, "k long, x double, y long, z string").repartition(4)
    spec = {"x": ["min", "max", "mean", "std", "sum", "nunique"], "y": ["min", "max", "mean", "std", "sum", "nunique"], "z": ["nunique", "min", "max", "count"]}
    got = A.agg_multi_spec(df, "k", spec, "t", extra=[F.count(F.lit(1)).alias("n")])
    assert "REPARTITION" in got._jdf.queryExecution().executedPlan().toString()
    want = df.groupBy("k").agg(*A.agg_exprs(spec, "t"), F.count(F.lit(1)).alias("n"))
    assert got.columns == want.columns

    def plain(frame):
        return sorted((tuple(None if v is None else "nan" if isinstance(v, float) and math.isnan(v) else round(v, 8) + 0.0 if isinstance(v, float) else v for v in r)
                       for r in frame.collect()), key=str)
    assert plain(got) == plain(want)


def test_few_groups_are_combined_before_they_move(spark):
    df = spark.range(20_000).select((F.col("id") % 5).alias("k"), *[(F.col("id") % n).alias(f"c{n}") for n in (3, 7, 11, 13)])
    got = A.agg_multi_spec(df, "k", {c: ["min", "max", "mean", "sum", "var"] for c in df.columns[1:]}, "t")
    assert "REPARTITION" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 5


def test_agg_all_columns_moves_rows_not_buffers(spark, tmp_path):
    from featherstack.catalog.joins_agg import agg_all_columns_q
    nums = [(F.col("id") * k % 997).cast(t).alias(c) for k, (c, t) in enumerate(
        {"l_partkey": "long", "l_suppkey": "long", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
         "l_tax": "double"}.items(), 2)]
    li = spark.range(12_000).select((F.col("id") * 7919 % 3000).alias("l_orderkey"), *nums, F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
                                    F.timestamp_seconds("id").alias("l_shipdate"))
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = agg_all_columns_q(spark, str(tmp_path))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" in text and got.count() == 3000
    assert got.agg(F.sum("li_l_partkey_sum")).first()[0] == li.agg(F.sum("l_partkey")).first()[0]


def test_dealt_rows_that_compress_well_are_not_joined_into_one_task(spark, monkeypatch):
    monkeypatch.setattr(A, "DEALT_ROWS", 4000)
    df = spark.range(24_000).select((F.col("id") % 6000).alias("k"), *[F.lit(1.0).alias(f"c{i}") for i in range(4)])  # few bytes, many groups
    got = A.agg_multi_spec(df, "k", {c: ["min", "max", "mean", "sum", "var"] for c in df.columns[1:]}, "t")
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2000
    assert got.agg(F.sum("t_c0_sum")).first()[0] == 24_000.0


def test_wide_buffers_get_more_tasks(spark, monkeypatch):
    df = spark.range(24_000).select((F.col("id") % 6000).alias("k"), *[F.lit(1.0).alias(f"c{i}") for i in range(4)])
    monkeypatch.setattr(A, "DEALT_ROWS", 10**9)
    monkeypatch.setattr(A, "DEALT_VALUES", 6000)
    got = A.agg_multi_spec(df, "k", {c: ["min", "max", "mean", "sum", "var"] for c in df.columns[1:]}, "t")
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and len(sizes) > 8 and max(sizes) < 1000
