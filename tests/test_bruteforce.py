"""Rows-only operators checked against numpy brute force on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherstack.operators import encode as En
from featherstack.operators import knn as K
from featherstack.operators import scale as Sc
from sf_paths import SF_SMALL


def test_svd_projection_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    k = 4
    got = Sc.svd_reduce(emb, "embedding", k).select("vec_id", *[f"svd{j}" for j in range(k)]).toPandas()
    rows = emb.select("vec_id", "embedding").toPandas()
    x = np.stack(rows["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_numpy())
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    want = x @ vt[:k].T
    got = got.set_index("vec_id").loc[rows["vec_id"]].to_numpy()
    for j in range(k):  # singular vectors are defined up to sign
        a, b = got[:, j], want[:, j]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6 * max(1.0, np.abs(b).max())


def test_range_finder_matches_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 12)) * 2.0 ** -np.arange(12) @ rng.normal(size=(12, 40))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(5)
    v = Sc.right_singular(df, 40, 4, gram_dim=16)  # a wide table: sketched
    exact = Sc.right_singular(df, 40, 4)
    want = np.linalg.svd(x, full_matrices=False)[2][:4].T
    for got in (v, exact):
        assert np.allclose(np.abs((got * want).sum(axis=0)), 1, atol=1e-6)


def test_svd_of_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [2.0, 0.0]), (5, [None, 1.0])], "i int, v array<double>")
    got = {r["i"]: r["svd0"] for r in Sc.svd_reduce(df, "v", 1).collect()}
    assert abs(got[1]) == 1 and abs(got[4]) == 2 and got[2] is None and got[3] is None and got[5] is None
    assert Sc.svd_reduce(df.limit(0), "v", 2).count() == 0


def test_polynomial_contrasts_orthonormal():
    for k in (2, 3, 5, 8):
        m = En.polynomial_matrix(k)
        assert m.shape == (k, k - 1)
        assert np.allclose(m.T @ m, np.eye(k - 1), atol=1e-10)
        assert np.allclose(m.sum(axis=0), 0.0, atol=1e-10)  # orthogonal to the constant


@pytest.mark.parametrize(("rows", "cell", "other"), [(20_000, 2_000, False), (40, 30, False), (7, 10, True), (20_000, 1, True)])
def test_knn_matches_numpy(spark, rows, cell, other):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 6)) * 8
    base = [(i, (centres[i % 5] + rng.normal(size=6)).tolist(), int(rng.integers(0, 3))) for i in range(180)]
    base += [(200 + i, [1.0] * 6, i % 2) for i in range(12)] + [(300, None, 1)]  # ties, no vector
    query = [(i, v) for i, v, _ in base if i % 9 == 0] + [(1000, rng.normal(size=6).tolist()), (1001, [1.0] * 6), (1002, None)]
    b = spark.createDataFrame(base, "id long, v array<double>, y long")
    q = spark.createDataFrame(query, "id long, v array<double>")
    got = {}
    for r in K.knn_neighbours(b, q, "id", "id", "v", "y", 5, block_rows=rows, cell_rows=cell, other=other).collect():
        got.setdefault(r["__q"], []).append((r["rn"], r["__b"]))
    for qid, qv in query:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(qv)) ** 2).sum())), i) for i, v, _ in base
                      if v is not None and qv is not None and not (other and i == qid))
        assert [bid for _, bid in sorted(got.get(qid, []))] == [i for _, i in near[:5]]
    assert K.knn_neighbours(b.limit(0), q, "id", "id", "v", "y", 5).count() == 0


def test_knn_visits_few_cells_of_clustered_rows(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 20
    x = [(i, (centres[i % 8] + rng.normal(size=16)).tolist(), 0) for i in range(800)]
    base = spark.createDataFrame(x, "__bk long, __vec array<double>, __lab long")
    _, cells = K.fit_cells(base, 6, cell_rows=20)
    query = base.where("__bk % 10 = 0").select(F.col("__bk").alias("__qk"), "__vec")
    assert len(cells.pivots) == 40 and K.visits(query, cells).count() < 0.4 * 80 * 40


def least_squares(values, weights, k):
    """The least sum of squares of k runs, by trying every cut."""
    n = len(values)

    def cost(i, j):
        v, w = values[i:j], weights[i:j]
        return float((w * (v - np.average(v, weights=w)) ** 2).sum())
    best = [cost(0, j) for j in range(1, n + 1)]
    for c in range(1, min(k, n)):
        best = [min((best[i - 1] + cost(i, j) for i in range(c, j)), default=np.inf) for j in range(1, n + 1)]
    return best[-1]


@pytest.mark.parametrize("k", [1, 2, 3, 8, 64])
def test_optimal_clusters_against_every_cut(k):
    from featherstack.operators.cluster import optimal_cuts
    rng = np.random.default_rng(k)
    values = np.sort(np.concatenate([rng.normal(size=20), rng.normal(size=15) * 0.1 + 5, rng.exponential(size=15) * 9]))
    weights = rng.integers(1, 9, len(values)).astype(float)
    cuts, total = optimal_cuts(values, weights, k)
    assert len(cuts) == min(k, len(values)) - 1 and cuts == sorted(set(cuts))
    assert total == pytest.approx(least_squares(values, weights, k), rel=1e-9, abs=1e-9)


def test_kmeans_1d_of_rows(spark):
    from featherstack.operators.bins import kmeans_1d
    from featherstack.operators.cluster import cluster_of, fit_clusters
    df = spark.createDataFrame([(i, float(i % 10) if i % 7 else None) for i in range(200)], "i int, x double")
    out = kmeans_1d(df, "x", [2, 3, 64], "c", fill=100.0, log1p=False).collect()
    assert len(out) == 200 and {r["c_2"] for r in out} == {0, 1} and all((r["c_2"] == 1) == (r["x"] is None) for r in out)
    assert {r["c_3"] for r in out} == {0, 1, 2} and {r["c_64"] for r in out} == set(range(11))  # no more clusters than values
    many = spark.range(3000).select((F.col("id") * F.col("id")).cast("double").alias("x"))  # beyond the points: bins
    begins = fit_clusters(many, F.col("x"), 8, most=256)[8]
    exact = fit_clusters(many, F.col("x"), 8)[8]
    sums = [many.groupBy(cluster_of(F.col("x"), b)).agg(F.var_pop("x") * F.count("x")).agg(F.sum("(var_pop(x) * count(x))")).first()[0] for b in (begins, exact)]
    assert len(begins) == 7 and sums[1] <= sums[0] <= 1.01 * sums[1]
    assert kmeans_1d(df.limit(0), "x", 4, "c").count() == 0
