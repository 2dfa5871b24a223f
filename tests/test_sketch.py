"""Distinct counts by sketches merged over two levels."""

from pyspark.sql import functions as F

from featherstack.operators import sketch as Sk


def test_merged_sketches_are_near_the_exact_counts(spark):
    rows = spark.range(60_000).select((F.col("id") % 3000).alias("child"), (F.col("id") % 3).alias("parent"), (F.col("id") * 7 % 20_000).alias("a"),
                                      F.when(F.col("id") % 3 == 0, F.col("id") % 11).alias("b"))
    children = Sk.distinct_sketches(rows, ["parent", "child"], ["a", "b"])
    plan = children._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_hll_sketch_agg" in plan
    got = {r["parent"]: r for r in Sk.distinct_estimates(Sk.merge_sketches(children, "parent", ["a", "b"]), ["a", "b"]).collect()}
    exact = {r["parent"]: r for r in rows.groupBy("parent").agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).collect()}
    for p, r in exact.items():
        assert abs(got[p]["nunique_a"] - r["a"]) <= 0.08 * r["a"] and got[p]["nunique_b"] == r["b"]
    assert Sk.distinct_estimates(Sk.distinct_sketches(rows.limit(0), "parent", ["a"]), ["a"]).count() == 0
