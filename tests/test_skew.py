"""Joins back onto rows when one key holds a third of them."""

import pytest
from pyspark.sql import functions as F

from featherstack.operators import groupstats as G
from featherstack.operators.skew import heavy_buckets, split_join


@pytest.fixture
def no_help(spark):
    """No broadcast, and nothing that AQE could mend."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).alias("x"))


def share_of_largest_task(df):
    n = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(n) / sum(n)


def test_rows_of_a_hot_key_are_spread(spark, no_help):
    df = hot_rows(spark)
    stats = df.groupBy("k").agg(F.count("*").alias("n"))
    assert share_of_largest_task(df.join(stats, "k")) > 0.33
    assert share_of_largest_task(split_join(df, stats, "k")) < 0.12
    assert share_of_largest_task(G.broadcast_count(df, "k")) < 0.12
    assert share_of_largest_task(G.group_recipes(df, [(["k"], [("x", "mean")])])) < 0.12


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_is_the_join(spark, no_help, how):
    df = hot_rows(spark, 3000)
    stats = df.where("x > 2").groupBy("k").agg(F.sum("x").alias("s"))
    want = sorted(map(tuple, df.join(stats, "k", how).select("id", "k", "x", "s").collect()))
    assert sorted(map(tuple, split_join(df, stats, "k", how).select("id", "k", "x", "s").collect())) == want
    twice = stats.unionByName(stats)  # several rows of a key on the right, repeated rows on the left
    left = df.unionByName(df)
    want = sorted(map(tuple, left.join(twice, "k", how).select("id", "k", "x", "s").collect()), key=str)
    assert sorted(map(tuple, split_join(left, twice, "k", how).select("id", "k", "x", "s").collect()), key=str) == want


def test_sketch_names_heavy_buckets_only(spark):
    parts = heavy_buckets(hot_rows(spark), ["k"]).first()["parts"]
    assert sum(p for p in parts.values()) <= 64 + len(parts) and max(parts.values()) == 22
    assert heavy_buckets(hot_rows(spark).limit(0), ["k"]).first()["parts"] is None or not heavy_buckets(hot_rows(spark).limit(0), ["k"]).first()["parts"]
    assert split_join(hot_rows(spark).limit(0), hot_rows(spark).select("k").distinct(), "k").count() == 0


def test_outer_joins_are_refused(spark):
    with pytest.raises(ValueError):
        split_join(hot_rows(spark), hot_rows(spark), "k", "outer")
