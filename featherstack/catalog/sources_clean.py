"""§2.1 scans/sinks and §2.2 projection, filter and cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..operators import folds as fo
from ..operators.agg import agg_multi_spec
from ..operators.joins import null_columns_for_keys, select_new_columns
from ..operators.rank import global_quantiles
from ..plans import fixture as fx
from ..sources import sinks
from ..sources.tables import scan_table
from .common import register, table

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
CUST_EXACT = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


# ---------------------------------------------------------------- 2.1 sources
@register("scan_table", "SELECT * FROM customer", exact=CUST_EXACT)
def scan_table_q(spark, d):
    return scan_table(spark, f"{d}/customer.parquet", schema=CUSTOMER_SCHEMA)


@register("scan_limit_rows", f"SELECT * FROM {fx.PREVIOUS_SQL} p ORDER BY o_orderkey LIMIT 1000",
          exact=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "day"])
def scan_limit_rows_q(spark, d):
    p = fx.previous(spark, d)
    return p.orderBy("o_orderkey").limit(1000)


@register("scan_projected", "SELECT c_custkey, c_acctbal FROM customer", exact=["c_custkey"])
def scan_projected_q(spark, d):
    return scan_table(spark, f"{d}/customer.parquet", columns=["c_custkey", "c_acctbal"])


def _customer_feature_table(spark, d):
    return agg_multi_spec(fx.previous(spark, d), "o_custkey", {"o_totalprice": ["max", "min"], "day": ["max", "min"]},
                          "prev", extra=[F.count(F.lit(1)).alias("prev_size")])


FEATURE_TABLE_SQL = f"""SELECT o_custkey, max(o_totalprice) AS prev_o_totalprice_max, min(o_totalprice) AS prev_o_totalprice_min,
  max(day) AS prev_day_max, min(day) AS prev_day_min, count(*) AS prev_size FROM {fx.PREVIOUS_SQL} p GROUP BY o_custkey"""


@register("scan_feature_cache", FEATURE_TABLE_SQL, exact=["o_custkey", "prev_day_max", "prev_day_min", "prev_size"])
def scan_feature_cache_q(spark, d):
    """Feature table written once to shared storage and read back by key."""
    path = sinks.scratch_path(spark, "features")
    sinks.write_table(_customer_feature_table(spark, d), path)
    return spark.read.parquet(path)


@register("scan_folds", f"""SELECT a.c_custkey, a.c_acctbal, f.fold FROM customer a JOIN
  (SELECT c_custkey, CAST(((c_custkey % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER) AS fold FROM customer) f
  USING (c_custkey)""", exact=["c_custkey", "fold"])
def scan_folds_q(spark, d):
    """A shared fold table is written, read back and joined by key."""
    cust = table(spark, d, "customer")
    path = sinks.scratch_path(spark, "folds")
    sinks.write_table(fo.assign_folds(cust.select("c_custkey"), "c_custkey"), path)
    return fo.folds_from_table(cust.select("c_custkey", "c_acctbal"), spark.read.parquet(path), "c_custkey")


def _doc_scores(spark, d):
    lab = fx.labelled_documents(spark, d)
    return lab.select("doc_id", "quality", fo.fold_of("doc_id").alias("fold"),
                      (F.log1p("n_chars") / 10).alias("m0"),
                      ((F.col("n_chars") % 97) / 97.0).alias("m1"),
                      F.when(F.col("lang") == "en", 0.7).otherwise(0.3).alias("m2"))


@register("scan_glob_predictions", """SELECT doc_id, CAST(((doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER) AS fold,
  'm0' AS model, ln(1 + n_chars) / 10 AS score FROM documents
  UNION ALL SELECT doc_id, CAST(((doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER), 'm1', (n_chars % 97) / 97.0
  FROM documents WHERE lang <> 'de'
  UNION ALL SELECT d.doc_id, CAST(((d.doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER), 'm2', (n_chars % 13) / 13.0
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id""", exact=["doc_id", "fold", "model"])
def scan_glob_predictions_q(spark, d):
    """Per-model OOF files written as ``<model>_oof_train.csv``, read back by one glob scan."""
    from ..sources.predictions import scan_glob_predictions, write_model_predictions
    from .joins_agg import _long_predictions
    root = sinks.scratch_path(spark, "oof-files")
    long = _long_predictions(spark, d)
    for m in ("m0", "m1", "m2"):
        write_model_predictions(long.where(F.col("model") == m).select("doc_id", "fold", "score"), root, m)
    return scan_glob_predictions(spark, f"{root}/*_oof_train.csv", "doc_id long, fold int, score double",
                                 r"/([^/]+)_oof_train\.csv/")


_SCORES = """(SELECT d.doc_id, l.quality, CAST(((d.doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER) AS fold,
  ln(1 + n_chars) / 10 AS m0, (n_chars % 97) / 97.0 AS m1, CASE WHEN lang = 'en' THEN 0.7 ELSE 0.3 END AS m2
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@register("write_submission", f"SELECT doc_id, m0 AS \"TARGET\" FROM {_SCORES}", exact=["doc_id"])
def write_submission_q(spark, d):
    s = _doc_scores(spark, d)
    path = sinks.scratch_path(spark, "submission")
    sinks.write_submission(s, "doc_id", "m0", path)
    return spark.read.schema("doc_id long, TARGET double").option("header", True).csv(path)


@register("write_oof", " UNION ALL ".join(f"SELECT doc_id, CAST({m} AS DOUBLE) AS \"TARGET\", '{m}' AS model FROM {_SCORES}" for m in ("m0", "m1", "m2")),
          exact=["doc_id", "model"])
def write_oof_q(spark, d):
    s = _doc_scores(spark, d)
    path = sinks.scratch_path(spark, "oof")
    for m in ("m0", "m1", "m2", "m1"):  # a model written twice is there once
        sinks.write_oof(s, "doc_id", m, m, path)
    return spark.read.parquet(path)


@register("write_oof_scored_name", f"""SELECT doc_id, m0, auc AS path_auc FROM {_SCORES},
  (SELECT (sum(ar) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0)
    / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0)) AS auc, count(*) AS n
  FROM (SELECT *, rank() OVER ( ORDER BY m0) + (count(*) OVER (PARTITION BY  m0) - 1) / 2.0 AS ar FROM {_SCORES}) r ) a""", exact=["doc_id"], dec_cols={"path_auc": 5})
def write_oof_scored_name_q(spark, d):
    from ..operators.metrics import auc
    s = _doc_scores(spark, d)
    value = auc(s, "m0", "quality").first()["auc"]
    root = sinks.scratch_path(spark, "scored")
    path = sinks.write_scored_name(s.select("doc_id", "m0"), root, value, "m0_oof")
    back = spark.read.schema("doc_id long, m0 double").option("header", True).csv(path)
    return back.withColumn("path_auc", F.regexp_extract(F.col("_metadata.file_path"), "m0_oof_([0-9.]+)/", 1).cast("double"))


@register("persist_evaluation", f"SELECT doc_id, quality, m1 AS y_pred FROM {_SCORES}", exact=["doc_id", "quality"])
def persist_evaluation_q(spark, d):
    s = _doc_scores(spark, d)
    path = sinks.scratch_path(spark, "evaluation")
    sinks.persist_evaluation(s, "doc_id", "quality", "m1", path)
    return spark.read.parquet(path)


@register("write_fold_scores", f"""SELECT fold, auc, n_pos, n_neg FROM
  (SELECT (sum(ar) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0)
    / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0)) AS auc, fold, count(*) FILTER (WHERE quality = 1) AS n_pos, count(*) FILTER (WHERE quality = 0) AS n_neg
  FROM (SELECT *, rank() OVER (PARTITION BY fold ORDER BY m0) + (count(*) OVER (PARTITION BY fold, m0) - 1) / 2.0 AS ar FROM {_SCORES}) r GROUP BY fold) a""",
          exact=["fold", "n_pos", "n_neg"])
def write_fold_scores_q(spark, d):
    from ..operators.metrics import auc
    s = _doc_scores(spark, d)
    path = sinks.scratch_path(spark, "folds-auc")
    sinks.write_fold_scores(auc(s, "m0", "quality", ["fold"]), path)
    return spark.read.schema("fold int, auc double, n_pos long, n_neg long").option("header", True).csv(path)


@register("verify_submission", """WITH s AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id),
  t AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY doc_id),
  j AS (SELECT s.n AS sn, t.n AS tn FROM s FULL OUTER JOIN t ON s.doc_id IS NOT DISTINCT FROM t.doc_id),
  c AS (SELECT CAST(coalesce(sum(sn), 0) AS BIGINT) AS n_submission, CAST(coalesce(sum(tn), 0) AS BIGINT) AS n_sample,
    count(*) FILTER (WHERE sn IS NULL) AS n_missing, count(*) FILTER (WHERE tn IS NULL) AS n_extra,
    count(*) FILTER (WHERE sn > 1) AS n_repeated FROM j)
  SELECT *, n_submission = n_sample AND n_missing = 0 AND n_extra = 0 AND n_repeated = 0 AS ok FROM c""", all_exact=True)
def verify_submission_q(spark, d):
    """The labelled subset checked against the full document list as sample."""
    return sinks.verify_submission(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id")


# ---------------------------------------------------------------- 2.2 cleaning
@register("sentinel_to_null", f"""SELECT o_orderkey, nullif(o_orderstatus, 'O') AS o_orderstatus,
  CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  nullif(day, 0) AS day FROM {fx.PREVIOUS_SQL} p""", all_exact=True)
def sentinel_to_null_q(spark, d):
    p = fx.previous(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority", "day")
    return clean.sentinel_to_null(p, {"o_orderstatus": "O", "o_orderpriority": ["5-LOW", "4-NOT SPECIFIED"], "day": 0})


@register("outlier_to_null", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_nationkey > 20 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer""",
          exact=["c_custkey", "c_nationkey"])
def outlier_to_null_q(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return clean.outlier_to_null(c, {"c_acctbal": F.col("c_acctbal") < 0, "c_nationkey": F.col("c_nationkey") > 20})


@register("cap_value", """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 300000.0 ELSE o_totalprice END AS o_totalprice
  FROM orders""", exact=["o_orderkey"])
def cap_value_q(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", clean.cap_value("o_totalprice", 300000.0).alias("o_totalprice"))


@register("clip_range", """SELECT l_orderkey, l_linenumber, greatest(least(l_discount, 0.08), 0.02) AS l_discount
  FROM lineitem""", exact=["l_orderkey", "l_linenumber"])
def clip_range_q(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", clean.clip_range("l_discount", 0.02, 0.08).alias("l_discount"))


@register("inf_to_null", """SELECT c_custkey, CASE WHEN c_nationkey IN (3, 7) THEN NULL ELSE c_acctbal END AS x
  FROM customer""", exact=["c_custkey"])
def inf_to_null_q(spark, d):
    """±inf planted on two nations (as a division by zero would give), then cleaned."""
    c = table(spark, d, "customer")
    x = (F.when(F.col("c_nationkey") == 3, F.lit(float("inf")))
         .when(F.col("c_nationkey") == 7, F.lit(float("-inf"))).otherwise(F.col("c_acctbal")))
    return c.select("c_custkey", clean.inf_to_null(x).alias("x"))


@register("fill_constant", f"""SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), 'XNA') AS o_orderstatus,
  coalesce(CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END, -999.0) AS o_totalprice
  FROM orders""", exact=["o_orderkey", "o_orderstatus"])
def fill_constant_q(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    o = clean.sentinel_to_null(o, {"o_orderstatus": "O"})
    o = clean.outlier_to_null(o, {"o_totalprice": F.col("o_totalprice") > 400000})
    return clean.fill_constant(o, {"o_orderstatus": "XNA", "o_totalprice": -999.0})


def _fill_global(spark, d, stat):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    c = clean.outlier_to_null(c, {"c_acctbal": F.col("c_acctbal") < 0})
    if stat == "mean":
        value = c.agg(F.avg("c_acctbal")).first()[0]  # one number to the driver
    else:
        value = global_quantiles(c, ["c_acctbal"], [0.5])["c_acctbal"][0]
    return clean.fill_from_stats(c, {"c_acctbal": value})


@register("fill_global_mean", """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)
  SELECT c_custkey, coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM c)) AS c_acctbal FROM c""", exact=["c_custkey"])
def fill_global_mean_q(spark, d):
    return _fill_global(spark, d, "mean")


@register("fill_global_median", """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)
  SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM c)) AS c_acctbal FROM c""", exact=["c_custkey"])
def fill_global_median_q(spark, d):
    """Exact global median from distributed cumulative counts (no single-task sort)."""
    return _fill_global(spark, d, "median")


@register("membership_flag", """SELECT c_custkey, CAST(coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY'), false) AS INTEGER) AS seg_flag
  FROM customer""", all_exact=True)
def membership_flag_q(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", clean.membership_flag("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("seg_flag"))


@register("collapse_rare", """SELECT o_orderkey, CASE WHEN coalesce(nullif(o_orderpriority, '3-MEDIUM') IN ('1-URGENT', '2-HIGH'), false)
  THEN o_orderpriority ELSE 'Other' END AS priority FROM orders""", all_exact=True)
def collapse_rare_q(spark, d):
    o = clean.sentinel_to_null(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"),
                               {"o_orderpriority": "3-MEDIUM"})
    return o.select("o_orderkey", clean.collapse_rare("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("priority"))


@register("missing_flag", """SELECT o_orderkey, CAST(nullif(o_orderstatus, 'O') IS NULL AS INTEGER) AS status_missing
  FROM orders""", all_exact=True)
def missing_flag_q(spark, d):
    o = clean.sentinel_to_null(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), {"o_orderstatus": "O"})
    return o.select("o_orderkey", clean.missing_flag("o_orderstatus").alias("status_missing"))


@register("compare_flag", """SELECT c_custkey, CAST(coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END > 5000, false) AS INTEGER) AS rich
  FROM customer""", all_exact=True)
def compare_flag_q(spark, d):
    c = clean.outlier_to_null(table(spark, d, "customer").select("c_custkey", "c_acctbal"),
                              {"c_acctbal": F.col("c_acctbal") < 0})
    return c.select("c_custkey", clean.compare_flag(F.col("c_acctbal") > 5000).alias("rich"))


@register("filter_category", f"SELECT * FROM {fx.PREVIOUS_SQL} p WHERE o_orderstatus = 'F'",
          exact=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "day"])
def filter_category_q(spark, d):
    return fx.previous(spark, d).where(F.col("o_orderstatus") == "F")


@register("filter_range", f"SELECT o_custkey, count(*) AS n_recent FROM {fx.INSTALLMENTS_SQL} i WHERE due_day > -730 GROUP BY o_custkey",
          all_exact=True)
def filter_range_q(spark, d):
    i = fx.installments(spark, d).where(F.col("due_day") > -730)
    return i.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_recent"))


@register("filter_not_equal_null_keep", """SELECT o_orderkey, nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders
  WHERE nullif(o_orderstatus, 'O') IS DISTINCT FROM 'F'""", all_exact=True)
def filter_not_equal_null_keep_q(spark, d):
    o = clean.sentinel_to_null(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), {"o_orderstatus": "O"})
    return o.where(clean.not_equal_keep_null("o_orderstatus", "F"))


@register("null_columns_for_keys", """WITH ids AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 450000)
  SELECT c.c_custkey, c.c_name, c.c_mktsegment,
    CASE WHEN i.o_custkey IS NULL THEN c.c_acctbal END AS c_acctbal,
    CASE WHEN i.o_custkey IS NULL THEN c.c_nationkey END AS c_nationkey
  FROM customer c LEFT JOIN ids i ON c.c_custkey = i.o_custkey""", exact=CUST_EXACT)
def null_columns_for_keys_q(spark, d):
    """Customers with a very large order get every column named like '*_nation*' or '*acct*' blanked."""
    c = table(spark, d, "customer")
    ids = table(spark, d, "orders").where(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    out = null_columns_for_keys(c, ids, "c_custkey", "acct")
    return null_columns_for_keys_keep(out, ids)


def null_columns_for_keys_keep(df, ids):
    return null_columns_for_keys(df, ids, "c_custkey", "NATION")


@register("select_except", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", exact=["o_orderkey", "o_custkey"])
def select_except_q(spark, d):
    o = table(spark, d, "orders")
    drop = ["o_orderstatus", "o_orderdate", "o_orderpriority", "not_a_column"]
    return o.drop(*[c for c in drop if c in o.columns])


@register("select_new_columns", f"""SELECT c.*, f.prev_o_totalprice_max, f.prev_o_totalprice_min, f.prev_day_max, f.prev_day_min,
  f.prev_size FROM customer c LEFT JOIN ({FEATURE_TABLE_SQL}) f ON c.c_custkey = f.o_custkey""",
          exact=CUST_EXACT + ["prev_day_max", "prev_day_min", "prev_size"])
def select_new_columns_q(spark, d):
    c = table(spark, d, "customer")
    f = _customer_feature_table(spark, d).withColumnRenamed("o_custkey", "c_custkey") \
        .withColumn("c_acctbal", F.lit(0.0))  # present in both: must not be taken from the feature side
    return select_new_columns(c, f, "c_custkey")


@register("select_by_dtype", "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem", all_exact=True)
def select_by_dtype_q(spark, d):
    li = table(spark, d, "lineitem")
    strings = [f.name for f in li.schema.fields if isinstance(f.dataType, T.StringType)]
    return li.select("l_orderkey", "l_linenumber", *strings)


@register("select_by_name_pattern", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
          exact=["l_orderkey", "l_linenumber"])
def select_by_name_pattern_q(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *[c for c in li.columns if "price" in c])


@register("rename_positional", """SELECT doc_id, ln(1 + n_chars) / 10 AS model_0, (n_chars % 97) / 97.0 AS model_1
  FROM documents""", exact=["doc_id"])
def rename_positional_q(spark, d):
    docs = table(spark, d, "documents")
    preds = docs.select("doc_id", (F.log1p("n_chars") / 10).alias("lgb_v1"), ((F.col("n_chars") % 97) / 97.0).alias("knn_v2"))
    keys = ["doc_id"]
    return preds.toDF(*keys, *[f"model_{i}" for i in range(len(preds.columns) - len(keys))])


@register("boolean_to_number", f"SELECT c_custkey, CAST(is_train AS INTEGER) AS is_train FROM {fx.APPLICATION_SQL} a",
          all_exact=True)
def boolean_to_number_q(spark, d):
    return clean.boolean_to_number(fx.application(spark, d).select("c_custkey", "is_train"))


