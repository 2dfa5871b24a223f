"""No caps, hot keys, retries: operators at group counts, levels and skews that once failed."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from featherstack.models import oof
from featherstack.operators import agg as A
from featherstack.operators import blend as B
from featherstack.operators import encode as En
from featherstack.operators import ordered as O
from featherstack.operators import rank as R
from featherstack.operators.grouped import grouped_apply
from featherstack.operators.knn import knn_neighbours
from featherstack.sources import sinks


def _folds(spark, first=1):
    rows = [(i, float(i % 17), float((i * 7) % 11), int((i % 17) > 8), i % 5 + first) for i in range(200)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int, fold int")


def _logistic(size):
    return oof.fit_logistic(c=1.0, total_weight=size.weight)


def test_oof_takes_the_fold_ids_of_the_data(spark):
    got = oof.oof_fit_predict(_folds(spark), None, "id", "y", ["a", "b"], "fold", _logistic)[0].collect()
    assert sorted(r["id"] for r in got) == list(range(200)) and {r["fold"] for r in got} == {1, 2, 3, 4, 5}


def test_oof_refuses_rows_without_a_fold(spark):
    df = _folds(spark).withColumn("fold", F.when(F.col("id") > 3, F.col("fold")))
    with pytest.raises(ValueError, match="4 training rows have no fold"):
        oof.oof_fit_predict(df, None, "id", "y", ["a", "b"], "fold", _logistic)


def test_oof_preprocessing_reaches_the_test_rows(spark):
    df = _folds(spark).withColumn("a", F.col("a") * 1000 + 5)

    def prep(rows):
        model = StandardScaler(inputCol="features", outputCol="s", withMean=True).fit(rows)
        return lambda d: model.transform(d).drop("features").withColumnRenamed("s", "features")
    held, test = oof.oof_fit_predict(df, df.select("id", "a", "b"), "id", "y", ["a", "b"], "fold", _logistic, prep=prep)
    a, b = ({r["id"]: r["score"] for r in x.collect()} for x in (held, test))
    assert len(b) == 200 and max(abs(a[i] - b[i]) for i in a) < 0.1


def test_oof_sizes_are_those_of_the_fit(spark):
    seen = []

    def make(size):
        seen.append(tuple(size))
        return oof.fit_ridge(1.0, size.rows)
    df = _folds(spark).withColumn("w", F.lit(2.0))
    oof.oof_fit_predict(df, None, "id", "y", ["a", "b"], "fold", make, weight_col="w")
    assert seen == [(160, 320.0)] * 5


def test_boosted_trees_stop_early_on_the_held_out_fold(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal()), int(rng.random() < 0.5), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, y int, fold int")
    tr = oof.assemble(df, ["a"]).withColumn("label", F.col("y").cast("double"))
    model = next(iter(oof._models(tr, "fold", oof.fold_sizes(tr, "fold"), lambda s: oof.fit_gbt(30, 3, validation_col=oof.HELD), None)))[1]
    assert model.getNumTrees < 30


def test_bags_score_held_out_and_test_rows(spark):
    df = _folds(spark)
    o, t = oof.bagged_oof(df, df.select("id", "a", "b"), "id", "y", ["a", "b"], "fold",
                          lambda b, size: oof.fit_logistic(c=b, total_weight=size.weight), [1, 2])
    assert o.groupBy("id", "bag").count().where("count <> 1").count() == 0 and o.count() == 400
    assert t.groupBy("id", "bag", "fold").count().where("count <> 1").count() == 0 and t.count() == 2000


def test_ranks_in_ten_thousand_groups_and_null_groups(spark):
    df = spark.range(30_003).select(F.when(F.col("id") % 10_001 > 0, F.col("id") % 10_001).alias("g"), (F.col("id") * 7919 % 30_011).alias("v"))
    got = R.rank_columns(df, ["v"], "min", by=["g"]).toPandas()
    want = got.groupby("g", dropna=False)["v"].rank(method="min")
    assert len(got) == 30_003 and (got["v_rank"] == want).all()


def test_rank_average_per_group_counts_all_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 7.0), (2, 1.0), (None, 2.0)], "g int, v double")
    got = {(r["g"], r["v"]): r["o"] for r in B.rank_average(df, ["v"], "o", "min", ["g"]).collect()}
    assert got == {(1, 5.0): 0.5, (1, 7.0): 1.0, (2, 1.0): 1.0, (None, 2.0): 1.0}
    keyed = df.withColumn("k", F.col("v") * 10).withColumn("w", F.when(F.col("v") > 1, -F.col("v")))
    got = {r["k"]: r["o"] for r in B.rank_average(keyed, ["v", "w"], "o", "min", ["g"], key="k").collect()}
    assert got == {50.0: 0.75, 70.0: 0.75, 10.0: None, 20.0: 1.0}


def test_codes_of_a_thousand_levels(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 1001 > 0, F.concat(F.lit("v"), F.col("id") % 1001)).alias("c"))
    pdf = df.toPandas()
    levels = sorted(pdf["c"].dropna().unique())
    lab = En.label_encode(df, "c", "x").toPandas().set_index("id")["x"]
    assert (lab == pdf.set_index("id")["c"].fillna("nan").map({v: i for i, v in enumerate(sorted([*levels, "nan"]))})[lab.index]).all()
    fac = En.factor_code(df, "c", "x").toPandas().set_index("id")["x"]
    assert fac.isna().sum() == pdf["c"].isna().sum() and set(fac.dropna()) == set(range(1, 1001))
    seen = En.factorize_code(df, "c", "id", "x").toPandas().sort_values("id")["x"]
    assert (seen.to_numpy() == pd.factorize(pdf["c"])[0]).all()
    assert len(En.binary_encode(df, "c").columns) == 2 + 10


def test_submission_with_a_repeated_id_is_refused(spark):
    sample = spark.createDataFrame([(1,), (2,)], "id int")
    twice = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    r = sinks.verify_submission(twice, sample, "id").first()
    assert not r["ok"] and (r["n_submission"], r["n_sample"], r["n_repeated"]) == (3, 2, 1)
    assert not sinks.verify_submission(twice, twice, "id").first()["ok"]
    assert sinks.verify_submission(sample, sample, "id").first()["ok"]
    assert not sinks.verify_submission(sample.limit(0), sample, "id").first()["ok"]


def test_a_model_written_twice_is_there_once(spark, tmp_path):
    oofs = spark.range(100).withColumn("score", F.rand(1))
    for model in ("m0", "m1", "m0"):
        sinks.write_oof(oofs, "id", "score", model, str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).groupBy("model").count().collect() and spark.read.parquet(str(tmp_path)).count() == 200


def test_sums_of_values_finer_than_their_scale(spark):
    df = spark.createDataFrame([(1, 0.001)] * 10 + [(2, 0.07)] * 3, "k int, v double")
    got = {r["k"]: r["x_v_sum"] for r in A.agg_multi_spec(df, "k", {"v": ["sum"]}, "x", scales={"v": 2}).collect()}
    assert abs(got[1] - 0.01) < 1e-12 and got[2] == 0.21
    col = {r["k"]: r["s"] for r in df.groupBy("k").agg(A.agg_expr(F.col("v"), "sum", scale=2, name="s")).collect()}
    assert abs(col[1] - 0.01) < 1e-12 and col[2] == 0.21


def test_knn_ties_go_to_the_smaller_key(spark):
    base = spark.createDataFrame([(49 - i, [1.0, 0.0], 1) for i in range(50)], "id long, v array<double>, y long").repartition(1)
    query = spark.createDataFrame([(7, [0.0, 0.0])], "q long, v array<double>")
    for block in (1000, 7):
        got = knn_neighbours(base, query, "id", "q", "v", "y", 3, block_rows=block).orderBy("rn").collect()
        assert [r["__b"] for r in got] == [0, 1, 2]


def test_a_bursty_key_is_split_into_small_chunks(spark):
    """One row ten years before 20,000 rows of one moment."""
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(3650).alias("t"), "id", (F.col("id") % 7).cast("double").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(1, 0, -1, 2.0)], "k int, t int, id long, v double"))
    got = O.lagged_diff_mean(rows, "k", "t", "id", "v", {"null": "d", "zero": "z"}, chunks=12)
    s = rows.toPandas().sort_values(["t", "id"])["v"].diff()
    r = got.first()
    assert abs(r["d"] - s.mean()) < 1e-12 and abs(r["z"] - s.fillna(0).mean()) < 1e-12
    every = max(64, int(np.sqrt(20_001)))
    begins = rows.where(F.pmod(F.xxhash64("k", "t", "id"), F.lit(every)) == 0).orderBy("t", "id").toPandas()["id"]
    assert np.diff([-1, *begins, 20_000]).max() < 20 * every


def test_grouped_apply_never_sees_a_whole_group(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")

    def partial(pdf):
        assert len(pdf) < 600
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "s": [pdf["id"].sum()], "n": [len(pdf)]})

    def merge(parts):
        return pd.DataFrame({"k": [parts["k"].iloc[0]], "s": [parts["s"].sum()], "n": [parts["n"].sum()]})
    got = {r["k"]: (r["s"], r["n"]) for r in grouped_apply(df, "k", partial, merge, "k long, s long, n long", "k long, s long, n long", 250).collect()}
    assert got == {k: (sum(range(k, 5000, 2)), 2500) for k in (0, 1)}


def test_row_statistics_skip_nan_and_null(spark):
    from featherstack.functions import rowstats
    rows = [(float("nan"), 1.0, None, 4.0, 9.0), (None, None, None, None, None), (2.0, 2.0, 2.0, 2.0, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    fns = list(rowstats.ROW_FUNCS)
    got = df.select(*rowstats.row_stats(list("abcde"), fns, "r")).toPandas().astype(float)
    p = pd.DataFrame(rows, columns=list("abcde")).astype(float)
    for f in ("mean", "std", "sum", "median", "min", "max", "skew"):
        want = getattr(p, f)(axis=1)
        if f == "skew":
            want[2] = np.nan  # a constant row has none
        assert np.allclose(got[f"r_{f}"], want, equal_nan=True), f
    assert got["r_missing"].tolist() == [2, 5, 1] and got["r_present"].tolist() == [3, 0, 4]
