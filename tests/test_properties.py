"""Property tests against brute force on small generated inputs."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featherstack.operators import blend as B
from featherstack.operators import encode as En
from featherstack.operators import metrics as M
from featherstack.operators import ordered as O
from featherstack.operators import rank as R

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
scores = st.lists(st.integers(min_value=0, max_value=6), min_size=4, max_size=40)


@SETTINGS
@given(scores, st.lists(st.integers(0, 1), min_size=40, max_size=40))
def test_auc_symmetry_and_brute_force(spark, s, ys):
    ys = ys[:len(s)]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([(float(a), b) for a, b in zip(s, ys)], "s double, y int")
    a = M.auc(df, "s", "y").first()["auc"]
    neg = M.auc(df.withColumn("s", -F.col("s")), "s", "y").first()["auc"]
    pos = [x for x, y in zip(s, ys) if y == 1]
    negs = [x for x, y in zip(s, ys) if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in negs) / (len(pos) * len(negs))
    assert abs(a - brute) < 1e-12 and abs(a + neg - 1) < 1e-12


@SETTINGS
@given(scores)
def test_rank_blend_invariant_to_monotone_transform(spark, s):
    df = spark.createDataFrame([(i, float(a), float(a) * 3) for i, a in enumerate(s)], "id int, a double, b double")
    x = {r["id"]: r["blend"] for r in B.rank_average(df, ["a", "b"], "blend").collect()}
    t = df.withColumn("a", F.exp("a")).withColumn("b", F.col("b") * 10 + 7)
    y = {r["id"]: r["blend"] for r in B.rank_average(t, ["a", "b"], "blend").collect()}
    assert x == y


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.05, 0.25, 0.5, 0.9, 1.0]))
def test_distributed_quantile_equals_numpy(spark, xs, q):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = R.global_quantiles(df, ["x"], [q])["x"][0]
    assert abs(got - float(np.quantile(np.array(xs), q))) <= 1e-9 * max(1.0, abs(got))


def test_rank_with_few_buckets_equals_pandas(spark):
    rng = np.random.default_rng(7)
    vals = rng.integers(0, 50, 500).astype(float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, v double")
    got = {r["id"]: r["v_rank"] for r in R.rank_columns(df, ["v"], "min", buckets=4).collect()}
    want = pd.Series(vals).rank(method="min")
    assert all(got[i] == want[i] for i in range(len(vals)))


def test_lagged_diff_across_chunks_equals_pandas(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(3):
        for j in range(40):
            v = None if rng.random() < 0.1 else float(rng.integers(0, 100))
            rows.append((k, int(rng.integers(0, 200)), j, v))
    df = spark.createDataFrame(rows, "k int, t int, tb int, v double")
    got = {r["k"]: r["d"] for r in O.lagged_diff_mean(df, "k", "t", "tb", "v", {"null": "d"}).collect()}
    adaptive = {r["k"]: r["d"] for r in O.lagged_diff_mean(df, "k", "t", "tb", "v", {"null": "d"}, chunks=7).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "tb", "v"]).sort_values(["k", "t", "tb"])
    want = pdf.groupby("k")["v"].apply(lambda s: s.diff().mean())
    for k in range(3):
        assert abs(got[k] - want[k]) < 1e-9
        assert abs(adaptive[k] - want[k]) < 1e-9


def test_top_k_salted_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = [(int(rng.integers(0, 3)), i, float(rng.integers(0, 30))) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, id int, v double")
    got = {(r["k"], r["rn"]): r["id"] for r in
           O.top_k_per_group(df, "k", [F.col("v").desc(), F.col("id").desc()], 5, ["id"], salt=8).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "id", "v"]).sort_values(["k", "v", "id"], ascending=[True, False, False])
    for k, g in pdf.groupby("k"):
        for rn, i in enumerate(g["id"].head(5), start=1):
            assert got[(k, rn)] == i


def test_target_encoding_ignores_own_fold_labels(spark):
    base = [(i, "ab"[i % 2], i % 3, i % 5) for i in range(60)]
    df = spark.createDataFrame(base, "id int, c string, y int, fold int")
    flipped = spark.createDataFrame([(i, c, (1 - y % 2) if f == 0 else y, f) for i, c, y, f in base],
                                    "id int, c string, y int, fold int")
    a = {r["id"]: r["te"] for r in En.target_encode(df, "c", "y", "fold", "te").where("fold = 0").collect()}
    b = {r["id"]: r["te"] for r in En.target_encode(flipped, "c", "y", "fold", "te").where("fold = 0").collect()}
    assert a == b
