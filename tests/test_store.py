"""The bucketed feature store."""

import re

from pyspark.sql import functions as F

from featherstack.plans import features as FT
from featherstack.sources.store import FeatureStore
from sf_paths import SF_SMALL


def test_families_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = FeatureStore(spark, "c_custkey", buckets=4)
    try:
        df = FT.assemble_training_table(spark, SF_SMALL, store)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and len(re.findall("SortMergeJoin", plan)) == len(FT.APPLICATION_FAMILIES) + len(FT.CHILD_FAMILIES)
        assert df.count() == store.read("base").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        store.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(store.name)]


def test_a_store_is_read_by_its_name(spark):
    store = FeatureStore(spark, "k", name="kept_features", buckets=3)
    try:
        store.write("base", spark.range(20).withColumnRenamed("id", "k"))
        store.write("x", spark.range(0, 20, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")))
        again = FeatureStore(spark, "k", name="kept_features")
        got = {r["k"]: r["x"] for r in again.join("base", ["x"]).collect()}
        assert got == {i: 2 * i if i % 2 == 0 else None for i in range(20)}
        store.write("x", spark.range(1).select(F.col("id").alias("k"), F.lit(1).alias("x")))  # replaced
        assert again.read("x").count() == 1
    finally:
        store.drop()
