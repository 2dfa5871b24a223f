"""Fits from sufficient statistics and histogram stumps against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherstack.models import boosting, gram
from featherstack.models.selection import recursive_elimination


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)) * [1, 5, 0.2, 1, 1, 1] + [0, 3, 0, 0, 0, 0]
    x[:, 5] = 2.0  # constant
    y = (x[:, 0] + 0.3 * x[:, 1] + rng.normal(size=400) > 1).astype(float)
    return x, y, rng.integers(0, 5, 400)


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, fold = data
    return spark.createDataFrame([(i, *map(float, r), float(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold, strict=True))],
                                 "id int, " + ", ".join(f"x{j} double" for j in range(6)) + ", y double, fold int").repartition(7)


NAMES = [f"x{j}" for j in range(6)]


def test_ridge_scores_equal_the_closed_form(rows, data):
    x, y, fold = data
    extra = rows.limit(3).withColumn("y", F.lit(None).cast("double"))
    held, test = gram.ridge_oof(rows.unionByName(extra), rows.limit(5), "id", "y", NAMES, "fold", [0.5, 16.0])
    got = {(r["id"], r["alpha"]): r["score"] for r in held.collect()}
    assert len(got) == 800
    for f in range(5):
        for a in (0.5, 16.0):
            xt, yt = x[fold != f], y[fold != f]
            b = np.linalg.solve(xt.T @ xt + a * np.eye(6), xt.T @ yt)
            for i in np.flatnonzero(fold == f):
                assert got[i, a] == pytest.approx(x[i] @ b, abs=1e-9)
    assert test.count() == 5 * 5 * 2
    with pytest.raises(ValueError):
        gram.ridge_oof(rows.withColumn("fold", F.lit(None).cast("int")), None, "id", "y", NAMES, "fold", [1.0])


def test_elimination_equals_refits(rows, data):
    x, y, _ = data
    sd = x.std(axis=0)
    z = np.where(sd > 1e-9, (x - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1), 0)
    left, gone = list(range(6)), []
    while len(left) > 1:
        b = np.linalg.solve(z[:, left].T @ z[:, left] + np.eye(len(left)), z[:, left].T @ (y - y.mean()))
        for i in sorted(range(len(left)), key=lambda i: (abs(b[i]), NAMES[left[i]]))[:min(2, len(left) - 1)]:
            gone.append(left[i])
        left = [j for j in left if j not in gone]
    kept, order = gram.backward_elimination(gram.fold_grams(rows, NAMES, "y")[0], NAMES, keep=1, step=2)
    assert kept == [NAMES[j] for j in left] and order == [NAMES[j] for j in gone]
    assert recursive_elimination(rows, NAMES, "y", keep=1) == kept


def test_equal_weights_leave_by_name():
    """Three columns that only a rounding tells apart, in any order of theirs."""
    x = np.kron(np.eye(3), np.ones((4, 1)))
    a = np.concatenate([np.ones((12, 1)), x, np.ones((12, 1)) * np.arange(12)[:, None] % 2], axis=1)
    for order in ([0, 1, 2], [2, 0, 1]):
        g = a[:, [0, *[1 + j for j in order], 4]]
        kept, gone = gram.backward_elimination(g.T @ g * (1 + 1e-15), [f"x{j}" for j in order], keep=1, step=1)
        assert (kept, gone) == (["x2"], ["x0", "x1"])


def samme_r(bins, y, rounds, rate):
    """Plain real AdaBoost over the same bins, every split of every feature tried."""
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(bins.shape[1]):
            for cut in range(bins[:, f].max()):
                left = bins[:, f] <= cut
                if not left.any() or left.all():
                    continue
                gini = sum(2 * w[s & (y == 0)].sum() * w[s & (y == 1)].sum() / w[s].sum() for s in (left, ~left))
                if best is None or gini < best[0] * (1 - 1e-12):
                    best = (gini, f, cut, left)
        _, f, cut, left = best
        p = [min(max(w[s & (y == 1)].sum() / w[s].sum(), 1e-6), 1 - 1e-6) for s in (left, ~left)]
        h = [0.5 * np.log(q / (1 - q)) for q in p]
        out.append((f, cut, *h))
        w = w * np.exp(-rate * np.where(left, *h) * (2 * y - 1))
        w /= w.sum()
    return out


def test_stumps_equal_plain_adaboost(rows, data):
    x, y, _ = data
    model = boosting.fit_adaboost(rows, NAMES, "y", rounds=25, rate=0.3)
    bins = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)], axis=1)
    want = samme_r(bins, y, 25, 0.3)
    assert [(s.feature, s.cut) for s in model.stumps] == [(f, c) for f, c, *_ in want]
    assert np.allclose([(s.low, s.high) for s in model.stumps], [(a, b) for _, _, a, b in want])
    got = {r["id"]: r["score"] for r in boosting.adaboost_score(model, rows).collect()}
    raw = boosting.scores(bins, model.stumps, 0.3)
    assert np.allclose([got[i] for i in range(400)], 1 / (1 + np.exp(-2 * raw)))
    assert np.mean((np.array([got[i] for i in range(400)]) > 0.5) == (y == 1)) > 0.85
    assert boosting.fit_adaboost(rows.limit(0), NAMES, "y", rounds=3).stumps == ()
    constant = boosting.fit_adaboost(rows, ["x5"], "y", rounds=2)
    assert all(s.low == s.high for s in constant.stumps) and boosting.adaboost_score(constant, rows).count() == 400
