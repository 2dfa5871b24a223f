"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherstack.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, low=80, high=100, k=5, every=10):
    ok = [(i, la, [math.floor(256 * x) for x in v]) for i, v, la in rows
          if None not in (i, la, v) and all(x is not None and math.isfinite(x) for x in v)]
    ok = [r for r in ok if sum(x * x for x in r[2]) < 2**62]
    anchors = {}
    for i, la, v in ok:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (la, v)), (la, v), key=lambda x: (x[0], len(x[1]), np.array(x[1], "<i4").tobytes()))
    out = []
    for a, (la, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, lb) for i, lb, w in ok if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == la][:k]:
            fit = [(i, -t) for t, i, lb in scored if lb != la and low * -s <= 100 * -t <= high * -s][:k]
            out += [(a, p, r, i, -s, t) for r, (i, t) in enumerate(fit, 1)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "v": F.lit(1), "kind": F.lit("x"), "score": F.lit(0)})
    found = negatives.mine(negatives.quantised(df, "vec_id", "label", "embedding"), F.col("id") % 10 == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("size", [{}, {"anchors_per_tree": 3, "rows_per_task": 16}])
def test_negatives_against_brute_force(spark, size):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + r.normal(size=8) * 0.3).tolist(), int(r.integers(0, 3))) for i in range(150)]
    rows += [(200 + i, [0.5] * 8, i % 2) for i in range(12)]  # ties
    rows += [(300, None, 1), (310, [1.0, None] * 4, 1), (320, [math.nan] + [1.0] * 7, 1), (330, [math.inf] * 8, 0), (None, [1.0] * 8, 1),
             (340, [1.0] * 8, None), (350, [1e200] * 8, 1), (360, [], 1), (361, [], 1), (362, [], 0), (370, [1.0, 2.0], 1),
             (371, [1.0, 1.0], 1), (372, [1.0, 0.8], 0), (380, [0.0] * 8, 2)]
    rows += [(400, [0.3] * 8, 0), (400, [0.3] * 8, 0), (405, [0.31] * 8, 0), (405, [0.31] * 8, 0), (406, [0.29] * 8, 1), (406, [0.29] * 8, 1)]
    got, want = run(spark, rows, **size), brute(rows)
    assert len(want) > 200 and got == want
    assert run(spark, rows[:0], **size) == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(10, [8e5, 1 / 256], 0), (11, [8e5, 3.0], 0), (12, [8e5, 2.0], 1), (13, [8e5, 1.0], 1)]
    got = run(spark, rows)
    assert got == brute(rows) and [g[3] for g in got if g[0] == 10] == [12, 13]


def test_bounds_spare_most_scores_of_near_anchors():
    r = np.random.default_rng(1)
    centres = r.normal(size=(4, 16)) * 300
    x = np.rint(np.concatenate([c + r.normal(size=(50, 16)) * 4 for c in centres])).astype(np.int64)
    rows = np.rint(np.concatenate([c + r.normal(size=(500, 16)) * 40 for c in centres])).astype(np.int64)
    order, parent, edge = negatives.spanning_tree(x)
    assert sorted(order) == list(range(len(x))) and all(parent[k] < k for k in range(len(x)))
    assert np.allclose(edge[1:], np.linalg.norm(x[order[1:]] - x[order[parent[1:]]], axis=1))
    x = x[order]
    tree = negatives.Tree(x, parent, edge, np.arange(200), np.zeros(200, int), [[] for _ in x])
    true = rows @ x.T
    least = np.sort(true, axis=0)[-20]
    for a, at, score in tree.walk(rows, lambda k: (least[k], np.inf, np.ones(len(rows), bool))):
        want = np.flatnonzero(true[:, a] >= least[a])
        assert at.tolist() == want.tolist() and score.tolist() == true[want, a].tolist()
    assert tree.scored < 0.5 * tree.seen
