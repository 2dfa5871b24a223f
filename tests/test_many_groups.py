"""Millions of small groups in the pandas apply."""

from pyspark.sql import functions as F

from featherstack.catalog.window_scalar import grouped_apply_q
from featherstack.operators.grouped import grouped_apply


def write_orders(spark, tmp_path):
    big = 2**60
    rows = [(big + i, i % 700 if i % 50 else None, "O", float(i % 97) if i % 11 else None, f"2000-01-{1 + i * 7 % 28:02d}" if i % 13 else None, "5-LOW")
            for i in range(5000)] + [(9, 9000, "F", 1.0, None, "5-LOW")]
    o = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string, o_orderpriority string")
    o.select("*", F.col("d").cast("timestamp").alias("o_orderdate")).drop("d").repartition(5).write.parquet(f"{tmp_path}/orders.parquet")
    return rows


def test_grouped_apply_query_on_nulls_and_large_ids_without_a_call_a_group(spark, tmp_path):
    rows = write_orders(spark, tmp_path)
    df = grouped_apply_q(spark, str(tmp_path))
    assert "FlatMapGroupsInPandas" not in df._jdf.queryExecution().executedPlan().toString()
    want = {}
    for key in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == key]
        days = [int(r[4][-2:]) for r in own if r[4]]
        last = max(own, key=lambda r: (r[4] is None, r[4] or "", r[0]))  # NULL is the latest day
        want[key] = (len(own), last[3], max(days) - min(days) if days else None)
    got = {r["o_custkey"]: (r["ga_size"], r["ga_last_price"], r["ga_span_days"]) for r in df.collect()}
    assert got == want


def test_grouped_apply_of_many_groups_bounds_frames_and_merges_whole_groups(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 > 0, (F.col("id") % 901).cast("string")).alias("k"), "id")

    def partial(pdf):
        assert len(pdf) <= 250
        return pdf.groupby("k", dropna=False, as_index=False).agg(s=("id", "sum"), n=("id", "size"))

    def merge(parts):
        return parts.groupby("k", dropna=False, as_index=False)[["s", "n"]].sum()
    ddl = "k string, s long, n long"
    got = sorted(map(tuple, grouped_apply(df, "k", partial, merge, ddl, ddl, 250, many=True).collect()), key=str)
    assert got == sorted(map(tuple, df.groupBy("k").agg(F.sum("id"), F.count("*")).collect()), key=str)
