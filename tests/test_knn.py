"""The kNN join with every row as a query: whole, and equal to brute force."""

import numpy as np

import __spark_entry__ as E
from featherstack.operators import knn as K


def brute(base, query, k, other):
    """(key, [(distance, base key, label)]) of the first k by distance and key; rows of one query key are asked together."""
    out = {}
    for qid, qv in query:
        if qv is None or qid is None:
            continue
        out.setdefault(qid, []).extend((float(np.sqrt(((np.array(v) - np.array(qv)) ** 2).sum())), i, y) for i, v, y in base
                                       if None not in (i, v, y) and not (other and i == qid))
    return {q: sorted(near)[:k] for q, near in out.items()}


def vote(near):
    zero = any(d == 0 for d, _, _ in near)
    weight = {}
    for d, _, y in near:
        weight[y] = weight.get(y, 0.0) + (float(d == 0) if zero else 1 / d)
    label = min(weight, key=lambda y: (-weight[y], y))
    return label, weight[label] / sum(weight.values())


def test_every_vector_is_scored_among_all_others(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(1, 140)]
    rows += [(200 + i, [0.5] * 8, 2) for i in range(20)]  # copies of one vector
    rows += [(7, rng.normal(size=8).astype(np.float32).tolist(), 3), rows[8]]  # keys that come twice
    rows += [(300, None, 1), (301, [0.25] * 8, None), (None, [0.125] * 8, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in E.queries()["knn_score"](spark, str(tmp_path)).collect()}
    want = brute(rows, [(i, v) for i, v, _ in rows], 8, True)
    assert set(got) == set(want) and len(want) == 139 + 20 + 1
    for key, near in want.items():
        label, share = vote(near)
        assert got[key]["knn_label"] == label and abs(got[key]["knn_share"] - share) < 1e-7  # eight digits are kept


def test_rows_of_the_query_s_own_key_leave_room_for_others(spark):
    """Forty near rows of one key must not hide its neighbours, all in cells far away."""
    rng = np.random.default_rng(3)
    rows = [(1, (rng.normal(size=4) * 0.01).tolist(), 0) for _ in range(40)]
    rows += [(100 + i, (100 + rng.normal(size=4)).tolist(), 1) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y long")
    want = brute(rows, [(i, v) for i, v, _ in rows], 5, True)
    for cell in (5, 2_000):
        got = {}
        for r in K.knn_neighbours(df, df, "id", "id", "v", "y", 5, cell_rows=cell, other=True).collect():
            got.setdefault(r["__q"], []).append((r["rn"], r["__b"]))
        assert {q: [b for _, b in sorted(v)] for q, v in got.items()} == {q: [b for _, b, _ in near] for q, near in want.items()}


def test_many_copies_and_blocks_against_brute_force(spark):
    """A third of the rows are one vector, in a cell larger than a block; slices and blocks are cut small."""
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=5).round(1).tolist(), int(i) % 3) for i in rng.permutation(200)] + [(1000 - i, [1.0] * 5, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y long")
    for other in (False, True):
        want = brute(rows, [(i, v) for i, v, _ in rows], 6, other)
        got = {}
        for r in K.knn_neighbours(df, df, "id", "id", "v", "y", 6, block_rows=40, cell_rows=25, other=other).collect():
            got.setdefault(r["__q"], []).append((r["rn"], r["__b"], round(r["__d"], 9)))
        assert {q: [t[1:] for t in sorted(v)] for q, v in got.items()} == {q: [(b, round(d, 9)) for d, b, _ in near] for q, near in want.items()}


def test_a_query_goes_once_to_each_block(spark):
    """Where no cell can be ruled out, the rows moved grow with the blocks and not with the cells."""
    rng = np.random.default_rng(6)
    x = [(i, rng.normal(size=32).tolist(), 0) for i in range(600)]
    base = spark.createDataFrame(x, "__bk long, __vec array<double>, __lab long")
    _, cells = K.fit_cells(base, 8, cell_rows=20)
    query = base.selectExpr("__bk AS __qk", "__vec")
    _, _, blocks = cells.blocks(200)
    assert len(cells.pivots) == 30 and blocks < 8
    seen = K.visits(query, cells, 200)
    assert seen.count() == seen.select("__block", "__qk").distinct().count() <= 600 * blocks
    assert K.visitors(query, cells, 200).sum() == seen.count()
