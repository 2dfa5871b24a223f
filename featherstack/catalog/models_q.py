"""§2.13 cross-validation, models, blending and metrics.

Model table: documents ⟕ labels (target ``quality``); labelled documents are
the training rows, the rest are test rows; folds come from the key.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from ..models import boosting, gram, oof, selection
from ..operators import blend as B
from ..operators import encode as En
from ..operators import folds as fo
from ..operators import metrics as M
from ..operators.knn import knn_score
from ..plans import fixture as fx
from .common import register, table

FOLD_SQL = "CAST(((doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER)"


def model_table(spark, d):
    """(doc_id, quality, fold, numeric features…) for all documents; test rows
    have no label and no fold."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, d, "labels").select("doc_id", "quality")
    x = docs.join(lab, "doc_id", "left")
    levels = En.fit_levels(x, ["lang", "source"])
    feats = x.select("doc_id", "quality", F.when(F.col("quality").isNotNull(), fo.fold_of("doc_id")).alias("fold"),
                     F.log1p("n_chars").alias("log_chars"), (F.col("n_chars") % 97).cast("double").alias("mod97"),
                     *En.one_hot("lang", levels["lang"], prefix="lang"),
                     *En.one_hot("source", levels["source"], prefix="src"))
    return feats


def _split(spark, d):
    m = model_table(spark, d)
    features = [c for c in m.columns if c not in ("doc_id", "quality", "fold")]
    return m.where(F.col("quality").isNotNull()), m.where(F.col("quality").isNull()), features


# ---------------------------------------------------------------- folds
@register("assign_folds", f"SELECT doc_id, {FOLD_SQL} AS fold FROM documents", all_exact=True)
def assign_folds_q(spark, d):
    return fo.assign_folds(table(spark, d, "documents").select("doc_id"), "doc_id")


@register("folds_from_table", f"""SELECT l.doc_id, l.quality, f.fold FROM labels l JOIN
  (SELECT doc_id, CAST(((doc_id % 2147483647) * 48271 + 1002) % 2147483647 % 5 AS INTEGER) AS fold FROM documents) f USING (doc_id)""",
          all_exact=True)
def folds_from_table_q(spark, d):
    """Folds supplied as a table (here the stackers' seed 1002), joined by key."""
    folds = fo.assign_folds(table(spark, d, "documents").select("doc_id"), "doc_id", seed=1002)
    return fo.folds_from_table(table(spark, d, "labels").select("doc_id", "quality"), folds, "doc_id")


# ---------------------------------------------------------------- models
# A fit has no SQL twin; each query returns, for every key, what must hold of it:
# the fold that scored it, how often it was scored, and that the score is a
# probability, next to the areas under the curve being better than chance.
LABELLED = f"(SELECT doc_id, {FOLD_SQL} AS fold FROM labels WHERE quality IS NOT NULL)"
UNLABELLED = "(SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL))"
OOF_SQL = f"""SELECT doc_id, 'oof' AS part, fold, 1 AS n_scores, true AS in_range FROM {LABELLED}
  UNION ALL SELECT doc_id, 'test', NULL, 1, true FROM {UNLABELLED}"""
TEST_SQL = f"SELECT doc_id, 1 AS n_scores, true AS in_range FROM {UNLABELLED}"


def _judged(scored, keys, low=0.0, high=1.0):
    ok = F.bool_and(F.col("score").isNotNull() & F.col("score").between(low, high))
    return scored.groupBy(*keys).agg(F.count("*").cast("int").alias("n_scores"), ok.alias("in_range"))


def _oof(spark, d, make, low=0.0, high=1.0, **more):
    train, test, features = _split(spark, d)
    if "weight_col" in more:
        train = train.withColumn(more["weight_col"], fo.class_weight("quality", 3.0))
    o, t = oof.oof_fit_predict(train, test, "doc_id", "quality", features, "fold", make, **more)
    both = o.withColumn("part", F.lit("oof")).unionByName(t.withColumn("fold", F.lit(None).cast("int")).withColumn("part", F.lit("test")))
    return _judged(both, ["doc_id", "part", "fold"], low, high)


def _standardised(rows):
    """Preprocessing fitted on a fold's training rows: every feature to unit variance."""
    from pyspark.ml.feature import StandardScaler
    model = StandardScaler(inputCol="features", outputCol="__scaled", withMean=True).fit(rows)
    return lambda df: model.transform(df).drop("features").withColumnRenamed("__scaled", "features")


@register("oof_fit_predict", OOF_SQL, all_exact=True)
def oof_fit_predict_q(spark, d):
    """Logistic OOF and test scores; a scaler is fitted inside every fold."""
    return _oof(spark, d, lambda size: oof.fit_logistic(c=1.0, total_weight=size.weight), prep=_standardised)


@register("fit_gbt", OOF_SQL, all_exact=True)
def fit_gbt_q(spark, d):
    """Boosted trees that stop early on the held-out fold."""
    return _oof(spark, d, lambda size: oof.fit_gbt(max_iter=40, max_depth=3, validation_col=oof.HELD))


@register("fit_logistic", OOF_SQL, all_exact=True)
def fit_logistic_q(spark, d):
    """Class weights; the penalty follows the weight that each fit sees."""
    return _oof(spark, d, lambda size: oof.fit_logistic(c=0.1, total_weight=size.weight, weight_col="w"), weight_col="w")


# The model table's features as one list, the sums of their outer products, and a
# Gauss-Jordan elimination as a recursive query: SQL that fits the same ridge.
DESIGN = """lv AS (SELECT list(DISTINCT lang ORDER BY lang) FILTER (WHERE lang IS NOT NULL) AS langs, list(DISTINCT source ORDER BY source) FILTER (WHERE source IS NOT NULL) AS sources FROM documents),
  x AS MATERIALIZED (SELECT d.doc_id, l.quality::DOUBLE AS y, CASE WHEN l.quality IS NOT NULL THEN {fold} END AS fold,
    list_concat([coalesce(ln(1 + d.n_chars), 0)::DOUBLE, coalesce(d.n_chars % 97, 0)::DOUBLE],
      list_concat(list_transform(langs, lambda v: coalesce(d.lang = v, false)::INT::DOUBLE), list_transform(sources, lambda v: coalesce(d.source = v, false)::INT::DOUBLE))) AS v
    FROM documents d LEFT JOIN labels l USING (doc_id), lv)""".format(fold=FOLD_SQL.replace("doc_id", "d.doc_id"))


def _jordan(name: str, start: str, extra: str = "") -> str:
    """A recursive query that turns the left square of each matrix ``m`` (a list of rows) into the identity."""
    return f"""{name} AS ({start} UNION ALL
    SELECT {extra}k + 1, list_transform(range(1, len(m) + 1), lambda i: CASE WHEN i = k + 1 THEN list_transform(m[k + 1], lambda t: t / m[k + 1][k + 1])
      ELSE list_transform(range(1, len(m[1]) + 1), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
    FROM {name} WHERE k < len(m))"""


RIDGE_SQL = f"""WITH RECURSIVE {DESIGN},
  f AS (SELECT DISTINCT fold FROM x WHERE fold IS NOT NULL),
  e AS (SELECT doc_id, fold, y, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS xi, v FROM x WHERE fold IS NOT NULL),
  g AS (SELECT f.fold, e.i, list_concat(list_transform(range(1, (SELECT len(langs) + len(sources) + 3 FROM lv)), lambda j: 0.0::DOUBLE), []) AS z,
      list(e.xi ORDER BY e.doc_id) AS xi, list(e.v ORDER BY e.doc_id) AS vs, list(e.y ORDER BY e.doc_id) AS ys FROM f JOIN e ON e.fold <> f.fold GROUP BY f.fold, e.i),
  s AS (SELECT fold, list(list_concat(list_transform(range(1, len(z) + 1), lambda j: list_dot_product(xi, list_transform(vs, lambda r: r[j])) + CASE WHEN i = j THEN {{alpha}} ELSE 0 END),
      [list_dot_product(xi, ys)]) ORDER BY i) AS m FROM g GROUP BY fold),
  {_jordan('r', 'SELECT fold, 0 AS k, m FROM s', 'fold, ')},
  b AS (SELECT fold, list_transform(m, lambda t: t[len(t)]) AS beta FROM r WHERE k = len(m))"""


@register("fit_ridge", RIDGE_SQL.format(alpha=16.0) + """
  SELECT x.doc_id, 'oof' AS part, x.fold, list_dot_product(x.v, b.beta) AS score FROM x JOIN b USING (fold)
  UNION ALL SELECT x.doc_id, 'test', NULL, avg(list_dot_product(x.v, b.beta)) FROM x, b WHERE x.fold IS NULL GROUP BY x.doc_id""",
          exact=["doc_id", "part", "fold"], sig=8)
def fit_ridge_q(spark, d):
    """Ridge scores of every document: the held-out ones of the labelled, the mean of five fits of the others."""
    train, test, features = _split(spark, d)
    held, scored = gram.ridge_oof(train, test, "doc_id", "quality", features, "fold", [min(4.0 ** 2, 333.0)])
    mean = scored.groupBy("doc_id").agg(F.avg("score").alias("score")).select("doc_id", F.lit("test").alias("part"), F.lit(None).cast("int").alias("fold"), "score")
    return held.select("doc_id", F.lit("oof").alias("part"), "fold", "score").unionByName(mean)


@register("ridge_bags", " UNION ALL ".join(f"SELECT * FROM ({RIDGE_SQL.format(alpha=a)} SELECT doc_id, fold, CAST({a} AS DOUBLE) AS alpha, list_dot_product(v, beta) AS score FROM x JOIN b USING (fold))"
                                          for a in (1.0, 4.0, 9.0, 16.0, 25.0)), exact=["doc_id", "fold"], sig=8)
def ridge_bags_q(spark, d):
    """Five penalties by five folds: 25 ridge fits from one scan, every held-out score."""
    train, _, features = _split(spark, d)
    return gram.ridge_oof(train, None, "doc_id", "quality", features, "fold", [c ** 2 for c in (1.0, 2.0, 3.0, 4.0, 5.0)])[0]


@register("fit_mlp", OOF_SQL, all_exact=True)
def fit_mlp_q(spark, d):
    _, _, features = _split(spark, d)
    return _oof(spark, d, lambda size: oof.fit_mlp(len(features), hidden=(16, 8), max_iter=50))


@register("fit_adaboost", TEST_SQL, all_exact=True)
def fit_adaboost_q(spark, d):
    """150 rounds of stumps over histograms."""
    train, test, features = _split(spark, d)
    model = boosting.fit_adaboost(train, features, "quality", rounds=150, rate=0.3)
    return _judged(boosting.adaboost_score(model, test.select("doc_id", *features)), ["doc_id"])


@register("bagged_fit", f"""SELECT doc_id, 'oof' AS part, fold, bag, 1 AS n_scores, true AS in_range FROM {LABELLED}, range(1, 6) t(bag)
  UNION ALL SELECT doc_id, 'test', fold, bag, 1, true FROM {UNLABELLED}, range(0, 5) f(fold), range(1, 6) t(bag)""".replace(
      "fold, bag, 1", "CAST(fold AS INTEGER) AS fold, CAST(bag AS INTEGER) AS bag, 1"), all_exact=True)
def bagged_fit_q(spark, d):
    """Five bags by five folds, held-out and test scores of each."""
    train, test, features = _split(spark, d)
    o, t = oof.bagged_oof(train, test, "doc_id", "quality", features, "fold",
                          lambda c, size: oof.fit_logistic(c=0.1 * c, total_weight=size.weight), bags=[1, 2, 3, 4, 5])
    both = o.withColumn("part", F.lit("oof")).unionByName(t.withColumn("part", F.lit("test")))
    return _judged(both, ["doc_id", "part", "fold", "bag"])


@register("categorical_index", """WITH x AS (SELECT d.doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents d JOIN labels USING (doc_id)),
  li AS (SELECT lang, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS INTEGER) AS lang_idx FROM x GROUP BY lang),
  si AS (SELECT source, CAST(row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS INTEGER) AS source_idx FROM x GROUP BY source)
  SELECT doc_id, lang_idx, source_idx, true AS in_range FROM x JOIN li USING (lang) JOIN si USING (source)""", all_exact=True)
def categorical_index_q(spark, d):
    """Categories handed to the trees as categorical features (indexed by
    frequency, with maxBins above the level count)."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    x = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in ("lang", "source")]
    vec = VectorAssembler(inputCols=["lang_idx", "source_idx", "n_chars"], outputCol="features")
    pipe = Pipeline(stages=[*idx, vec, oof.fit_gbt(max_iter=10, max_depth=3, max_bins=64)])
    x = x.withColumn("label", F.col("quality").cast("double"))
    out = pipe.fit(x).transform(x)
    return out.select("doc_id", F.col("lang_idx").cast("int").alias("lang_idx"), F.col("source_idx").cast("int").alias("source_idx"),
                      oof.score_column(out).between(0.0, 1.0).alias("in_range"))


@register("search_params", f"""SELECT CAST(trial AS INTEGER) AS trial, (SELECT count(*) FROM {LABELLED}) AS n_scored,
  (SELECT count(DISTINCT fold) FROM {LABELLED}) AS n_folds, true AS auc_in_range FROM range(0, 3) t(trial)""", all_exact=True)
def search_params_q(spark, d):
    """Three trials over all folds; each trial's OOF scores are kept and read back."""
    from ..sources import sinks
    train, test, features = _split(spark, d)
    space = {"c": [0.01, 0.1, 1.0, 10.0], "maxIter": [20, 50]}
    path = sinks.scratch_path(spark, "search")
    trials = selection.search_params(train, "doc_id", "quality", features, "fold",
                                     lambda p: oof.fit_logistic(c=p["c"], total_weight=1000.0, max_iter=p["maxIter"]),
                                     space, trials=3, test=test, path=path)
    aucs = spark.createDataFrame([(t["trial"], 0.0 <= t["auc"] <= 1.0) for t in trials], "trial int, auc_in_range boolean")
    kept = spark.read.parquet(f"{path}/oof").groupBy("trial").agg(F.count("*").alias("n_scored"), F.count_distinct("fold").alias("n_folds"))
    return kept.join(aucs, "trial")


# Elimination in SQL: the inverse by Gauss-Jordan, then one downdate a row of the
# recursion; ``drop`` holds the columns that the current step chose.
@register("recursive_elimination", f"""WITH RECURSIVE {DESIGN},
  names AS (SELECT list_concat(['log_chars', 'mod97'], list_concat(list_transform(langs, lambda v: 'lang_' || lower(v)), list_transform(sources, lambda v: 'src_' || lower(v)))) AS names FROM lv),
  t AS (SELECT list(y ORDER BY doc_id) AS ys, list(v ORDER BY doc_id) AS vs FROM x WHERE fold IS NOT NULL),
  c AS (SELECT ys, list_transform(range(1, len(vs[1]) + 1), lambda j: list_transform(vs, lambda r: r[j])) AS cols FROM t),
  st AS (SELECT ys, list_transform(cols, lambda c: list_transform(c, lambda q: (q - list_avg(c)) / CASE WHEN list_var_pop(c) > 1e-24 THEN sqrt(list_var_pop(c)) ELSE 'inf'::DOUBLE END)) AS z FROM c),
  s AS (SELECT list_transform(z, lambda a, i: list_concat(list_transform(z, lambda b, j: list_dot_product(a, b) + CASE WHEN i = j THEN 1 ELSE 0 END),
      list_concat(list_transform(z, lambda b, j: CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0 END), [list_dot_product(a, ys)]))) AS m FROM st),
  {_jordan('r', 'SELECT 0 AS k, m FROM s')},
  i0 AS (SELECT list_transform(m, lambda t: t[len(m) + 1:2 * len(m)]) AS a, list_transform(m, lambda t: t[2 * len(m) + 1]) AS w FROM r WHERE k = len(m)),
  el AS (SELECT 0 AS n, names, a, w, []::VARCHAR[] AS todo, NULL::VARCHAR AS gone FROM i0, names
    UNION ALL SELECT n + 1, list_filter(names, lambda v, i: i <> p), list_transform(list_filter(a, lambda row, i: i <> p), lambda row: list_filter(list_transform(row, lambda v, j: v - row[p] * a[p][j] / a[p][p]), lambda v, j: j <> p)),
      list_filter(list_transform(w, lambda v, i: v - a[i][p] / a[p][p] * w[p]), lambda v, i: i <> p), pick[2:], pick[1]
    FROM (SELECT *, list_position(names, pick[1]) AS p FROM (SELECT *, CASE WHEN len(todo) > 0 THEN todo
        ELSE list_transform(list_sort(list_transform(names, lambda v, i: {{{{'s': round(abs(w[i]), 9), 'v': v}}}}))[1:least(2, len(names) - 4)], lambda q: q.v) END AS pick FROM el WHERE len(names) > 4)))
  SELECT CAST(n AS INTEGER) AS position, gone AS name, false AS kept FROM el WHERE gone IS NOT NULL
  UNION ALL SELECT CAST(n AS INTEGER), unnest(names), true FROM el WHERE len(names) = 4""".replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}"), all_exact=True)
def recursive_elimination_q(spark, d):
    """Two weakest columns a step until four are left: which left when, and which stayed."""
    train, _, features = _split(spark, d)
    kept, gone = gram.backward_elimination(gram.fold_grams(train, features, "quality")[0], features, keep=4, step=2)
    rows = [(i, name, False) for i, name in enumerate(gone, 1)] + [(len(gone), name, True) for name in kept]
    return spark.createDataFrame(rows, "position int, name string, kept boolean")


# ---------------------------------------------------------------- kNN (exact, SQL-checked)
KNN_SQL = """WITH q AS (SELECT vec_id, embedding FROM embeddings),
  b AS (SELECT vec_id, embedding, label FROM embeddings),
  d AS (SELECT q.vec_id AS qid, b.vec_id AS bid, b.label,
          sqrt(list_sum(list_transform(list_zip(q.embedding, b.embedding), lambda z: pow(z[1]::DOUBLE - z[2]::DOUBLE, 2)))) AS dist
        FROM q JOIN b ON q.vec_id <> b.vec_id),
  n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rn FROM d),
  k AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS hz FROM n WHERE rn <= 8),
  v AS (SELECT qid, label, sum(CASE WHEN hz = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END) AS vw FROM k GROUP BY ALL),
  r AS (SELECT qid, label, vw / sum(vw) OVER (PARTITION BY qid) AS share,
          row_number() OVER (PARTITION BY qid ORDER BY vw DESC, label) AS rk FROM v)
  SELECT qid AS vec_id, CAST(label AS BIGINT) AS knn_label, share AS knn_share FROM r WHERE rk = 1"""


@register("knn_score", KNN_SQL, exact=["vec_id", "knn_label"], sig=8)
def knn_score_q(spark, d):
    """8 nearest other vectors (Euclidean, 1/d weights) of every vector, among all."""
    emb = table(spark, d, "embeddings")
    return knn_score(emb, emb, "vec_id", "vec_id", "embedding", "label", 8, other=True)


# ---------------------------------------------------------------- blends and metrics
def _fold_scores(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return docs.select("doc_id", *[(F.col("n_chars") % (7 + f)).cast("double").alias(f"s{f}") for f in range(5)])


@register("rank_average_blend", """SELECT doc_id, (""" + " + ".join(f"rank() OVER (ORDER BY n_chars % {7 + f})" for f in range(5)) +
          """) / 5.0 / count(*) OVER () AS blend FROM documents""", exact=["doc_id"])
def rank_average_blend_q(spark, d):
    """Test scores of 5 fold models → min-rank average over n."""
    return B.rank_average(_fold_scores(spark, d), [f"s{f}" for f in range(5)], "blend", "min", key="doc_id").select("doc_id", "blend")


@register("mean_blend", "SELECT doc_id, (" + " + ".join(f"(n_chars % {7 + f})" for f in range(5)) + ") / 5.0 AS score FROM documents",
          exact=["doc_id"])
def mean_blend_q(spark, d):
    s = _fold_scores(spark, d)
    long = s.select("doc_id", F.explode(F.array(*[F.col(f"s{f}") for f in range(5)])).alias("score"))
    return B.mean_blend(long, "doc_id", "score")


def _auc_sql(by: str | None) -> str:
    part = f"PARTITION BY {by}" if by else ""
    grp = f"{by}, " if by else ""
    return f"""WITH s AS (SELECT d.doc_id, {FOLD_SQL.replace('doc_id', 'd.doc_id')} AS fold, l.quality AS y, (d.n_chars % 50)::DOUBLE AS score
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
  r AS (SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER ({part + ',' if by else 'PARTITION BY'} score) - 1) / 2.0 AS ar FROM s)
  SELECT {grp}(sum(ar) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
    / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc,
    count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg FROM r GROUP BY ALL"""


def _auc_input(spark, d):
    x = fx.labelled_documents(spark, d)
    return x.select("doc_id", fo.fold_of("doc_id").alias("fold"), F.col("quality"),
                    (F.col("n_chars") % 50).cast("double").alias("score"))


@register("auc_score", _auc_sql(None).replace("SELECT (sum", "SELECT 'all' AS part, (sum"), exact=["part", "n_pos", "n_neg"])
def auc_score_q(spark, d):
    """Tie-aware AUC over all labelled rows."""
    return M.auc(_auc_input(spark, d), "score", "quality").withColumn("part", F.lit("all"))


@register("auc_per_fold", _auc_sql("fold"), exact=["fold", "n_pos", "n_neg"])
def auc_per_fold_q(spark, d):
    return M.auc(_auc_input(spark, d), "score", "quality", ["fold"])


@register("fold_auc_mean", f"SELECT avg(auc) AS fold_auc_mean, count(*) AS n_folds FROM ({_auc_sql('fold')})", exact=["n_folds"])
def fold_auc_mean_q(spark, d):
    return M.fold_auc_mean(_auc_input(spark, d), "score", "quality", "fold")


@register("class_weight_column", "SELECT doc_id, CASE WHEN quality = 1 THEN 3.0 ELSE 1.0 END AS weight FROM labels", exact=["doc_id"])
def class_weight_column_q(spark, d):
    lab = table(spark, d, "labels")
    return lab.select("doc_id", fo.class_weight("quality", 3.0).alias("weight"))


