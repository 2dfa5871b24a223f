"""Model properties (values cannot equal the reference's libraries)."""

from featherstack.models import boosting, oof
from featherstack.operators import folds as fo
from featherstack.operators import metrics as M


def _data(spark, n=300):
    rows = [(i, float(i % 17), float((i * 7) % 11), int((i % 17) > 8)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    return fo.assign_folds(df, "id", 5)


def test_oof_scores_each_key_once_by_an_unseen_fold(spark):
    df = _data(spark)
    o, t = oof.oof_fit_predict(df, df.select("id", "a", "b"), "id", "y", ["a", "b"], "fold",
                               lambda size: oof.fit_logistic(c=1.0, total_weight=size.weight))
    rows = o.collect()
    assert len(rows) == 300 and len({r["id"] for r in rows}) == 300
    folds = {r["id"]: r["fold"] for r in df.select("id", "fold").collect()}
    assert all(folds[r["id"]] == r["fold"] for r in rows)
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)
    assert t.count() == 300
    auc = M.auc(o.join(df.select("id", "y"), "id"), "score", "y").first()["auc"]
    assert auc > 0.5


def test_same_seed_same_result(spark):
    df = _data(spark)
    make = lambda size: oof.fit_gbt(max_iter=5, max_depth=2, seed=7)
    a = sorted((r["id"], r["score"]) for r in oof.oof_fit_predict(df, None, "id", "y", ["a", "b"], "fold", make)[0].collect())
    b = sorted((r["id"], r["score"]) for r in oof.oof_fit_predict(df, None, "id", "y", ["a", "b"], "fold", make)[0].collect())
    assert a == b


def test_adaboost_separates(spark):
    df = _data(spark)
    model = boosting.fit_adaboost(df, ["a", "b"], "y", rounds=4, rate=0.3)
    assert M.auc(boosting.adaboost_score(model, df.select("id", "y", "a", "b")), "score", "y").first()["auc"] > 0.9
