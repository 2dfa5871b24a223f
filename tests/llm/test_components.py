"""Connected components, and the hub of a star in their joins."""

import pytest
from pyspark.sql import functions as F

from featherstack.llm import components
from featherstack.llm.common import stage_table


def test_components_of_odd_edges(spark):
    edges = [(1, 2), (2, 1), (3, 3), (None, 4), (4, None), (9, 8), (8, 7), (7, 20), (5, 2), (2, 5)]
    got = {tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (7, 7), (8, 7), (9, 7), (20, 7)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture
def small_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.files.maxPartitionBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hub_with_a_third_of_the_edges_is_split(spark, small_tasks):
    n = 60_000
    edges = spark.range(1, n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") + n).alias("u"), F.col("id").alias("v"))
    both = stage_table(edges.repartition(8))
    low = stage_table(both.groupBy("u").agg(F.min("v").alias("m")))
    joined = both.join(low, "u").select("v", "m")
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    got = components.connected_components(edges)
    assert got.where("component = 0").count() == n // 3 and got.count() == n // 3 + 2 * (n - 1 - (n // 3 - 1))
