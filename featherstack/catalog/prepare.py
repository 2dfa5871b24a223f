"""§2.11 encoders and §2.12 bins, clusters, scaling, reduction, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import bins as Bn
from ..operators import encode as En
from ..operators import scale as Sc
from ..operators.folds import fold_of
from ..plans import fixture as fx
from .common import register, table
from .joins_agg import _long_predictions, _sel, wide_predictions

APP = fx.APPLICATION_SQL
SEGMENTS_SQL = "nullif(c_mktsegment, 'HOUSEHOLD')"


def _orders_pri(spark, d):
    return clean.sentinel_to_null(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"),
                                  {"o_orderpriority": "5-LOW"})


def _cust_seg(spark, d):
    return clean.sentinel_to_null(table(spark, d, "customer").select("c_custkey", "c_mktsegment"),
                                  {"c_mktsegment": "HOUSEHOLD"})


# ---------------------------------------------------------------- 2.11 encoders
@register("label_encode", """WITH o AS (SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'nan') AS v FROM orders),
  codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT v FROM o))
  SELECT o_orderkey, code AS priority_label FROM o JOIN codes USING (v)""", all_exact=True)
def label_encode_q(spark, d):
    o = _orders_pri(spark, d)
    return En.label_encode(o, "o_orderpriority", "priority_label").select("o_orderkey", "priority_label")


@register("factor_code", f"""WITH c AS (SELECT c_custkey, {SEGMENTS_SQL} AS v FROM customer),
  codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS code FROM (SELECT DISTINCT v FROM c WHERE v IS NOT NULL))
  SELECT c_custkey, code AS segment_factor FROM c LEFT JOIN codes USING (v)""", all_exact=True)
def factor_code_q(spark, d):
    c = _cust_seg(spark, d)
    return En.factor_code(c, "c_mktsegment", "segment_factor").select("c_custkey", "segment_factor")


@register("factorize_appearance", """WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS v FROM orders),
  codes AS (SELECT v, CAST(row_number() OVER (ORDER BY min(o_orderkey), v) - 1 AS INTEGER) AS code FROM o WHERE v IS NOT NULL GROUP BY v)
  SELECT o_orderkey, coalesce(code, -1) AS priority_code FROM o LEFT JOIN codes USING (v)""", all_exact=True)
def factorize_appearance_q(spark, d):
    o = _orders_pri(spark, d)
    return En.factorize_code(o, "o_orderpriority", "o_orderkey", "priority_code").select("o_orderkey", "priority_code")


SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@register("one_hot", f"""SELECT c_custkey, {_sel([f"CAST(coalesce({SEGMENTS_SQL} = '{s}', false) AS INTEGER) AS seg_{s.lower()}" for s in SEGS])},
  CAST({SEGMENTS_SQL} IS NULL AS INTEGER) AS seg_nan FROM customer""", all_exact=True)
def one_hot_q(spark, d):
    c = _cust_seg(spark, d)
    levels = En.fit_levels(c, ["c_mktsegment"])["c_mktsegment"]
    return c.select("c_custkey", *En.one_hot("c_mktsegment", levels, null_level=True, prefix="seg"))


@register("binary_encode", """WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS code FROM (SELECT DISTINCT p_brand AS v FROM part)),
  p AS (SELECT p_partkey, code FROM part JOIN codes ON p_brand = v),
  w AS (SELECT CAST(floor(log2((SELECT count(*) FROM codes))) + 1 AS INTEGER) AS nd)
  SELECT p_partkey, """ + _sel([f"CASE WHEN {i} < nd THEN CAST((code >> (nd - 1 - {i})) & 1 AS INTEGER) END AS brand_bin{i}" for i in range(5)]) +
          " FROM p, w", all_exact=True)
def binary_encode_q(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return En.binary_encode(p, "p_brand", prefix="brand").drop("p_brand")


def _helmert_sql() -> str:
    cols = _sel([f"CASE WHEN code IS NULL THEN 0.0 WHEN code < {j} THEN -1.0 WHEN code = {j} THEN {float(j)} ELSE 0.0 END AS seg_helm{j - 1}"
                 for j in range(1, len(SEGS))])
    return f"""WITH c AS (SELECT c_custkey, {SEGMENTS_SQL} AS v FROM customer),
  codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM c WHERE v IS NOT NULL))
  SELECT c_custkey, {cols} FROM c LEFT JOIN codes USING (v)"""


@register("helmert_encode", _helmert_sql(), exact=["c_custkey"])
def helmert_encode_q(spark, d):
    c = _cust_seg(spark, d)
    levels = En.fit_levels(c, ["c_mktsegment"])["c_mktsegment"]
    return c.select("c_custkey", *En.contrast_encode("c_mktsegment", levels, En.helmert_matrix(len(levels)), "helm", "seg"))


def _polynomial_sql() -> str:
    """Contrasts of four equally spaced levels, from their textbook integers."""
    contrasts = [((-3, -1, 1, 3), 20), ((1, -1, -1, 1), 4), ((-1, 3, -3, 1), 20)]
    cols = _sel(["CASE code " + " ".join(f"WHEN {i} THEN {v} / sqrt({n})" for i, v in enumerate(c)) + f" ELSE 0.0 END AS seg_poly{j}"
                 for j, (c, n) in enumerate(contrasts)])
    return f"""WITH c AS (SELECT c_custkey, {SEGMENTS_SQL} AS v FROM customer),
  codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM c WHERE v IS NOT NULL))
  SELECT c_custkey, {cols} FROM c LEFT JOIN codes USING (v)"""


@register("polynomial_encode", _polynomial_sql(), exact=["c_custkey"])
def polynomial_encode_q(spark, d):
    c = _cust_seg(spark, d)
    levels = En.fit_levels(c, ["c_mktsegment"])["c_mktsegment"]
    return c.select("c_custkey", *En.contrast_encode("c_mktsegment", levels, En.polynomial_matrix(len(levels)), "poly", "seg"))


_TE_FOLD = "CASE WHEN l.quality IS NOT NULL THEN CAST(((d.doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER) END"
TARGET_SQL = f"""WITH x AS (SELECT d.doc_id, coalesce(d.lang, 'nan') AS lv, l.quality AS y, {_TE_FOLD} AS fold
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
  per AS (SELECT lv, fold, sum(y)::DOUBLE AS s, count(*) AS n FROM x WHERE y IS NOT NULL GROUP BY ALL),
  tot AS (SELECT lv, sum(s) AS S, sum(n) AS N FROM per GROUP BY lv),
  ft AS (SELECT fold, sum(s) AS fs, sum(n) AS fn FROM per GROUP BY fold),
  g AS (SELECT sum(s) AS gs, sum(n) AS gn FROM per),
  j AS (SELECT x.doc_id, x.fold, coalesce(tot.N, 0) - coalesce(per.n, 0) AS nn, coalesce(tot.S, 0) - coalesce(per.s, 0) AS ss,
          (g.gs - coalesce(ft.fs, 0)) / nullif(g.gn - coalesce(ft.fn, 0), 0) AS prior
        FROM x LEFT JOIN tot USING (lv) LEFT JOIN per ON per.lv = x.lv AND per.fold = x.fold LEFT JOIN ft ON ft.fold = x.fold, g)
  SELECT doc_id, fold, CASE WHEN nn > 0 THEN prior * (1 - 1 / (1 + exp(-(nn - 1.0) / 1.0))) + ss / nn * (1 / (1 + exp(-(nn - 1.0) / 1.0)))
    ELSE prior END AS lang_te FROM j"""


@register("target_encode", TARGET_SQL, exact=["doc_id", "fold"])
def target_encode_q(spark, d):
    """Out-of-fold smoothed quality rate per language; unlabelled documents
    (no fold) use all labelled rows."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    lab = table(spark, d, "labels").select("doc_id", "quality")
    x = docs.join(lab, "doc_id", "left").withColumn("fold", F.when(F.col("quality").isNotNull(), fold_of("doc_id")))
    return En.target_encode(x, "lang", "quality", "fold", "lang_te").select("doc_id", "fold", "lang_te")


# ---------------------------------------------------------------- 2.12 bins, scaling, selection
def _qbin_sql(col: str, tbl: str, n: int, key: str, out: str) -> str:
    probs = ", ".join(repr(i / n) for i in range(n + 1))
    return f"""WITH e AS (SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) AS edges FROM {tbl}),
  i AS (SELECT list_slice(edges, 2, len(edges) - 1) AS inner_edges FROM e)
  SELECT {key}, CAST(CASE WHEN {col} IS NOT NULL THEN len(list_filter(inner_edges, lambda x: x < {col})) END AS INTEGER) AS {out}
  FROM {tbl}, i"""


@register("quantile_bin", f"""SELECT a.c_custkey, a.acct_bin, b.size_bin FROM ({_qbin_sql('c_acctbal', 'customer', 8, 'c_custkey', 'acct_bin')}) a
  JOIN ({_qbin_sql('(c_custkey % 7)', 'customer', 100, 'c_custkey', 'size_bin')}) b USING (c_custkey)""", all_exact=True)
def quantile_bin_q(spark, d):
    """qcut into 8 bins, and into 100 bins of a 7-valued column (duplicate edges dropped)."""
    c = table(spark, d, "customer").withColumn("k7", F.col("c_custkey") % 7)
    edges = Bn.fit_edges(c, ["c_acctbal", "k7"], {"c_acctbal": 8, "k7": 100})
    e1, e2 = edges["c_acctbal"], edges["k7"]
    return c.select("c_custkey", Bn.quantile_bin("c_acctbal", e1).alias("acct_bin"), Bn.quantile_bin("k7", e2).alias("size_bin"))


@register("kmeans_1d")
def kmeans_1d_q(spark, d):
    i = fx.installments(spark, d).withColumn("ratio", F.try_divide(F.col("payment"), F.col("instalment")))
    return Bn.kmeans_1d(i.select("l_orderkey", "l_linenumber", "ratio"), "ratio", 8, "ratio_cluster")


def _clusters_sql(x: str, tbl: str, k: int) -> str:
    """The best k runs of the distinct values of ``x`` by a recursive programme:
    ``starts`` holds (cluster, its smallest value)."""
    return f"""v AS (SELECT {x} AS x, count(*)::DOUBLE AS n FROM {tbl} GROUP BY 1),
  p AS (SELECT row_number() OVER (ORDER BY x) AS i, x, sum(n) OVER (ORDER BY x) AS w, sum(n * x) OVER (ORDER BY x) AS s, sum(n * x * x) OVER (ORDER BY x) AS q FROM v),
  z AS (SELECT i, x, w, s, q FROM p UNION ALL SELECT 0, NULL, 0, 0, 0),
  c AS (SELECT a.i + 1 AS i, b.i AS j, b.q - a.q - pow(b.s - a.s, 2) / (b.w - a.w) AS cost FROM z a JOIN z b ON a.i < b.i),
  d AS (SELECT 1 AS k, j, cost AS best, [1]::BIGINT[] AS path FROM c WHERE i = 1
    UNION ALL SELECT k, j, best, path FROM (SELECT d.k + 1 AS k, c.j, d.best + c.cost AS best, list_append(d.path, c.i) AS path,
        row_number() OVER (PARTITION BY c.j ORDER BY d.best + c.cost, c.i) AS rn
      FROM d JOIN c ON c.i = d.j + 1 WHERE d.k < {k}) WHERE rn = 1),
  last AS (SELECT path FROM d WHERE j = (SELECT max(i) FROM p) ORDER BY k DESC LIMIT 1),
  begin_at AS (SELECT unnest(path) AS i, unnest(range(len(path))) AS cluster FROM last),
  starts AS (SELECT cluster, x FROM begin_at JOIN p USING (i))"""


def _register_clusters(k: int) -> None:
    @register(f"kmeans_1d_{k}", f"""WITH RECURSIVE t AS (SELECT l_orderkey, l_linenumber, floor(l_extendedprice / 1000) AS x FROM lineitem),
  {_clusters_sql('x', 't', k)}
  SELECT l_orderkey, l_linenumber, (SELECT CAST(max(cluster) AS INTEGER) FROM starts WHERE starts.x <= t.x) AS price_cluster FROM t""", all_exact=True)
    def kmeans_1d_k(spark, d):
        """The best clusters of the price in thousands, by least squared error."""
        li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("x"))
        return Bn.kmeans_1d(li, "x", k, "price_cluster", log1p=False).drop("x")


for _k in (8, 64):
    _register_clusters(_k)


@register("robust_scale", f"""WITH t AS (SELECT median(c_acctbal) AS m, quantile_cont(c_acctbal, 0.95) - quantile_cont(c_acctbal, 0.05) AS r
    FROM {APP} a WHERE is_train)
  SELECT c_custkey, (c_acctbal - m) / coalesce(nullif(r, 0), 1) AS c_acctbal FROM customer, t""", exact=["c_custkey"])
def robust_scale_q(spark, d):
    app = fx.application(spark, d)
    return Sc.robust_scale(app.where("is_train"), app.select("c_custkey", "c_acctbal"), ["c_acctbal"])


@register("standard_scale", f"""WITH t AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM {APP} a WHERE is_train)
  SELECT c_custkey, (c_acctbal - m) / coalesce(nullif(s, 0), 1) AS c_acctbal FROM customer, t""", exact=["c_custkey"], sig=9)
def standard_scale_q(spark, d):
    app = fx.application(spark, d)
    return Sc.standard_scale(app.where("is_train"), app.select("c_custkey", "c_acctbal"), ["c_acctbal"])


@register("median_impute", f"""WITH c AS (SELECT c_custkey, (c_custkey % 5) <> 0 AS is_train, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS v FROM customer),
  t AS (SELECT median(v) AS m FROM c WHERE is_train)
  SELECT c_custkey, coalesce(v, m) AS c_acctbal FROM c, t""", exact=["c_custkey"])
def median_impute_q(spark, d):
    app = clean.outlier_to_null(fx.application(spark, d), {"c_acctbal": F.col("c_acctbal") < 0})
    return Sc.median_impute(app.where("is_train"), app.select("c_custkey", "c_acctbal"), ["c_acctbal"])


VT_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"]


@register("variance_threshold", "SELECT name, v AS var_pop, v > 0.03 AS kept FROM (UNPIVOT (SELECT " +
          ", ".join(f"var_pop({c}) AS {c}" for c in VT_COLS) + " FROM lineitem) ON COLUMNS(*) INTO NAME name VALUE v)",
          exact=["name", "kept"])
def variance_threshold_q(spark, d):
    """Population variance of each column and whether it passes 0.03 (one wide aggregate)."""
    li = table(spark, d, "lineitem")
    wide = li.agg(*[F.var_pop(c).alias(c) for c in VT_COLS])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("var_pop")) for c in VT_COLS]))
                       .alias("kv")).select("kv.*")
    kept = set(Sc.variance_threshold(li, VT_COLS, 0.03))
    return long.withColumn("kept", F.col("name").isin(*kept) if kept else F.lit(False))


@register("svd_reduce")
def svd_reduce_q(spark, d):
    emb = table(spark, d, "embeddings")
    return Sc.svd_reduce(emb, "embedding", 8).drop("embedding")


@register("select_oof_columns", """WITH p AS (SELECT doc_id, CAST(((doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER) AS fold,
    ln(1 + n_chars) / 10 AS m0, (n_chars % 13) / 13.0 AS m2 FROM documents d WHERE lang <> 'de' AND doc_id IN (SELECT doc_id FROM labels))
  SELECT * FROM p""", exact=["doc_id", "fold"])
def select_oof_columns_q(spark, d):
    """Pick prediction columns by position from the wide OOF matrix."""
    wide = wide_predictions(_long_predictions(spark, d), "doc_id", "fold", ["m0", "m1", "m2"])
    models = [c for c in wide.columns if c not in ("doc_id", "fold")]
    return wide.select("doc_id", "fold", *[models[i] for i in (0, 2)])
