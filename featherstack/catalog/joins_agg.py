"""§2.3 joins and §2.4 aggregations over the fixture mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, rowstats
from ..operators import agg as A
from ..operators import sketch as Sk
from ..operators import groupstats as G
from ..operators import ordered as O
from ..operators.joins import left_join_features, map_lookup, membership_isin
from ..plans import fixture as fx
from . import sqlgen as S
from .common import register, table

P, L, I, APP = fx.PREVIOUS_SQL, fx.LINES_SQL, fx.INSTALLMENTS_SQL, fx.APPLICATION_SQL
MONEY = {"o_totalprice": 2, "c_acctbal": 2, "l_extendedprice": 2, "l_quantity": 2, "l_discount": 2, "l_tax": 2,
         "p_retailprice": 2}


def _sel(items):
    return ",\n  ".join(items)


# ---------------------------------------------------------------- 2.3 joins
@register("left_join_features", f"""WITH p AS (SELECT o_custkey, count(*) AS prev_size, max(o_totalprice) AS prev_o_totalprice_max,
    min(day) AS prev_day_min FROM {P} x GROUP BY o_custkey),
  i AS (SELECT o_custkey, count(*) AS inst_size, coalesce(sum(payment), 0) AS inst_payment_sum FROM {I} y GROUP BY o_custkey)
  SELECT a.c_custkey, a.c_mktsegment, a.is_train, p.prev_size, p.prev_o_totalprice_max, p.prev_day_min, i.inst_size, i.inst_payment_sum
  FROM {APP} a LEFT JOIN p ON a.c_custkey = p.o_custkey LEFT JOIN i ON a.c_custkey = i.o_custkey""",
          exact=["c_custkey", "c_mktsegment", "is_train", "prev_size", "prev_day_min", "inst_size"])
def left_join_features_q(spark, d):
    app = fx.application(spark, d).select("c_custkey", "c_mktsegment", "is_train")
    p = A.agg_multi_spec(fx.previous(spark, d), "o_custkey", {"o_totalprice": ["max"], "day": ["min"]}, "prev",
                         extra=[F.count(F.lit(1)).alias("prev_size")])
    i = A.agg_multi_spec(fx.installments(spark, d), "o_custkey", {"payment": ["sum"]}, "inst",
                         extra=[F.count(F.lit(1)).alias("inst_size")])
    return left_join_features(app, [p.withColumnRenamed("o_custkey", "c_custkey"),
                                    i.withColumnRenamed("o_custkey", "c_custkey")], "c_custkey")


@register("left_join_multikey", f"""WITH g AS (SELECT c_mktsegment, c_nationkey, {S.agg('c_acctbal', 'mean', scale=2)} AS seg_nat_acctbal_mean,
    count(*) AS seg_nat_size FROM customer GROUP BY ALL)
  SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, g.seg_nat_acctbal_mean, g.seg_nat_size
  FROM customer c LEFT JOIN g USING (c_mktsegment, c_nationkey)""",
          exact=["c_custkey", "c_mktsegment", "c_nationkey", "seg_nat_size"])
def left_join_multikey_q(spark, d):
    c = table(spark, d, "customer")
    g = c.groupBy("c_mktsegment", "c_nationkey").agg(A.agg_expr("c_acctbal", "mean", scale=2).alias("seg_nat_acctbal_mean"),
                                                     F.count(F.lit(1)).alias("seg_nat_size"))
    return c.select("c_custkey", "c_mktsegment", "c_nationkey").join(g, ["c_mktsegment", "c_nationkey"], "left")


@register("map_lookup", """WITH m AS (SELECT c_nationkey, median(c_acctbal) AS nation_acctbal_median FROM customer GROUP BY c_nationkey)
  SELECT c.c_custkey, c.c_acctbal, m.nation_acctbal_median, c.c_acctbal / nullif(m.nation_acctbal_median, 0) AS acctbal_to_nation
  FROM customer c LEFT JOIN m USING (c_nationkey)""", exact=["c_custkey"])
def map_lookup_q(spark, d):
    c = table(spark, d, "customer")
    m = G.group_medians(c, "c_nationkey", {"c_acctbal": "nation_acctbal_median"})
    j = map_lookup(c, "c_nationkey", m)
    return j.select("c_custkey", "c_acctbal", "nation_acctbal_median",
                    F.try_divide(F.col("c_acctbal"), F.col("nation_acctbal_median")).alias("acctbal_to_nation"))


def _long_predictions(spark, d):
    """Three models' predictions (id, fold, model, score); m1 skips one language
    and m2 covers only the labelled documents, so an inner chain drops rows."""
    from ..operators.folds import fold_of
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, d, "labels").select("doc_id")
    fold = fold_of("doc_id")
    m0 = docs.select("doc_id", fold.alias("fold"), F.lit("m0").alias("model"), (F.log1p("n_chars") / 10).alias("score"))
    m1 = docs.where(F.col("lang") != "de").select("doc_id", fold.alias("fold"), F.lit("m1").alias("model"),
                                                  ((F.col("n_chars") % 97) / 97.0).alias("score"))
    m2 = docs.join(lab, "doc_id").select("doc_id", fold.alias("fold"), F.lit("m2").alias("model"),
                                         (F.col("n_chars") % 13 / 13.0).alias("score"))
    return m0.unionByName(m1).unionByName(m2)


def wide_predictions(long_df, key, fold, models):
    """Long predictions → one column per model, keeping only (key, fold) rows
    where every model is present (the inner-merge chain)."""
    wide = long_df.groupBy(key, fold).pivot("model", list(models)).agg(F.first("score"))
    return wide.where(F.greatest(*[F.col(m).isNull() for m in models]) == F.lit(False))


_FOLD_SQL = "CAST(((doc_id % 2147483647) * 48271 + 1001) % 2147483647 % 5 AS INTEGER)"
_PRED_SQL = f"""p0 AS (SELECT doc_id, {_FOLD_SQL} AS fold, ln(1 + n_chars) / 10 AS m0 FROM documents),
  p1 AS (SELECT doc_id, {_FOLD_SQL} AS fold, (n_chars % 97) / 97.0 AS m1 FROM documents WHERE lang <> 'de'),
  p2 AS (SELECT d.doc_id, {_FOLD_SQL.replace('doc_id', 'd.doc_id')} AS fold, (n_chars % 13) / 13.0 AS m2 FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@register("inner_join_chain", f"""WITH {_PRED_SQL}
  SELECT p0.doc_id, p0.fold, m0, m1, m2 FROM p0 JOIN p1 ON p0.doc_id = p1.doc_id AND p0.fold = p1.fold
  JOIN p2 ON p0.doc_id = p2.doc_id AND p0.fold = p2.fold""", exact=["doc_id", "fold"])
def inner_join_chain_q(spark, d):
    return wide_predictions(_long_predictions(spark, d), "doc_id", "fold", ["m0", "m1", "m2"])


@register("inner_join_labels", f"""WITH {_PRED_SQL}
  SELECT p0.doc_id, p0.fold, p0.m0, l.quality FROM p0 JOIN labels l ON p0.doc_id = l.doc_id""",
          exact=["doc_id", "fold", "quality"])
def inner_join_labels_q(spark, d):
    p = _long_predictions(spark, d).where(F.col("model") == "m0").select("doc_id", "fold", F.col("score").alias("m0"))
    return p.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "inner")


@register("join_extreme_back", f"""SELECT o_custkey, o_orderkey, day, o_totalprice FROM {P} p
  WHERE day = (SELECT max(day) FROM {P} q WHERE q.o_custkey = p.o_custkey)""", exact=["o_custkey", "o_orderkey", "day"])
def join_extreme_back_q(spark, d):
    """Rows at each customer's latest day, ties kept."""
    p = fx.previous(spark, d).select("o_custkey", "o_orderkey", "day", "o_totalprice")
    return O.extreme_rows(p, "o_custkey", "day", "max")


@register("join_last_entity_rows", f"""WITH last AS (SELECT o_custkey, arg_max(l_orderkey, (due_day, l_orderkey)) AS l_orderkey FROM {I} p GROUP BY o_custkey)
  SELECT i.o_custkey, i.l_orderkey, i.l_linenumber, i.payment FROM {I} i JOIN last USING (o_custkey, l_orderkey)""",
          exact=["o_custkey", "l_orderkey", "l_linenumber"])
def join_last_entity_rows_q(spark, d):
    """All instalment rows of each customer's latest order."""
    i = fx.installments(spark, d).select("o_custkey", "l_orderkey", "l_linenumber", "payment", "due_day")
    rows = O.last_entity_rows(i, "o_custkey", "l_orderkey", ["due_day", "l_orderkey"])
    return rows.drop("due_day")


@register("membership_isin", """SELECT c_custkey, CAST(c_custkey IN (SELECT user_id FROM events) AS INTEGER) AS has_events
  FROM customer""", all_exact=True)
def membership_isin_q(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    ids = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return membership_isin(c, ids, "c_custkey", "has_events")


@register("column_concat_by_key", f"""WITH a AS (SELECT o_custkey, max(day) AS prev_day_max FROM {P} x GROUP BY o_custkey),
  b AS (SELECT o_custkey, count(DISTINCT l_partkey) AS inst_parts FROM {I} y GROUP BY o_custkey)
  SELECT a.o_custkey, a.prev_day_max, b.inst_parts FROM a LEFT JOIN b USING (o_custkey)""", all_exact=True)
def column_concat_by_key_q(spark, d):
    a = fx.previous(spark, d).groupBy("o_custkey").agg(F.max("day").alias("prev_day_max"))
    b = fx.installments(spark, d).groupBy("o_custkey").agg(F.count_distinct("l_partkey").alias("inst_parts"))
    return a.join(b, "o_custkey", "left")


# ---------------------------------------------------------------- 2.4 aggregations
SPEC_PREV = {"o_totalprice": ["min", "max", "mean", "median", "sum", "var"], "day": ["min", "max", "mean"],
             "o_orderkey": ["count"], "o_orderpriority": ["nunique"]}


@register("agg_multi_spec", f"""SELECT o_custkey, {_sel(S.spec_sql(SPEC_PREV, 'prev', scales=MONEY))}, count(*) AS prev_size
  FROM {P} p GROUP BY o_custkey""",
          exact=["o_custkey", "prev_day_min", "prev_day_max", "prev_o_orderkey_count", "prev_o_orderpriority_nunique",
                 "prev_size"])
def agg_multi_spec_q(spark, d):
    return A.agg_multi_spec(fx.previous(spark, d), "o_custkey", SPEC_PREV, "prev", scales=MONEY,
                            extra=[F.count(F.lit(1)).alias("prev_size")])


LI_NUM = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_INT = ["l_partkey", "l_suppkey", "l_linenumber"]
ALL_FNS = ["min", "max", "mean", "sum", "var"]


@register("agg_all_columns", f"""SELECT l_orderkey, {_sel(S.spec_sql({c: ALL_FNS for c in LI_NUM}, 'li', scales=MONEY, int_sums=LI_INT))}
  FROM lineitem GROUP BY l_orderkey""",
          exact=["l_orderkey"] + [f"li_{c}_{f}" for c in LI_INT for f in ("min", "max", "sum")])
def agg_all_columns_q(spark, d):
    li = table(spark, d, "lineitem").drop("l_shipdate")
    cols = A.numeric_columns(li, exclude=["l_orderkey"])
    return A.agg_multi_spec(li, "l_orderkey", {c: ALL_FNS for c in cols}, "li", scales=MONEY)


SIX = ["mean", "std", "min", "max", "sum", "nunique"]
SIX_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


@register("summarise_all_six", f"""SELECT l_orderkey, {_sel(S.spec_sql({c: SIX for c in SIX_COLS}, 'ln', scales=MONEY, int_sums=['l_suppkey']))}
  FROM lineitem GROUP BY l_orderkey""",
          exact=["l_orderkey"] + [f"ln_{c}_nunique" for c in SIX_COLS] + [f"ln_l_suppkey_{f}" for f in ("min", "max", "sum")])
def summarise_all_six_q(spark, d):
    li = table(spark, d, "lineitem")
    return A.agg_multi_spec(li, "l_orderkey", {c: SIX for c in SIX_COLS}, "ln", scales=MONEY)


SHAPE = ["mean", "std", "min", "max", "sum", "median", "skew_e1071", "kurt_e1071", "iqr"]


@register("summarise_shape", f"""WITH x AS (SELECT o_custkey, o_totalprice AS v, avg(o_totalprice) OVER (PARTITION BY o_custkey) AS mu FROM {P} p),
  m AS (SELECT o_custkey, count(v) AS n, avg(pow(v - mu, 2)) AS m2, avg(pow(v - mu, 3)) AS m3, avg(pow(v - mu, 4)) AS m4
        FROM x GROUP BY o_custkey)
  SELECT p.o_custkey, {S.agg('o_totalprice', 'mean', scale=2)} AS shp_o_totalprice_mean, stddev_samp(o_totalprice) AS shp_o_totalprice_std,
    min(o_totalprice) AS shp_o_totalprice_min, max(o_totalprice) AS shp_o_totalprice_max,
    {S.agg('o_totalprice', 'sum', scale=2)} AS shp_o_totalprice_sum, median(o_totalprice) AS shp_o_totalprice_median,
    any_value(CASE WHEN m.m2 > 0 THEN m.m3 / pow(m.m2, 1.5) * pow((m.n - 1) / m.n, 1.5) END) AS shp_o_totalprice_skew_e1071,
    any_value(CASE WHEN m.m2 > 0 THEN (m.m4 / pow(m.m2, 2)) * pow(1 - 1 / m.n, 2) - 3 END) AS shp_o_totalprice_kurt_e1071,
    quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS shp_o_totalprice_iqr
  FROM {P} p JOIN m USING (o_custkey) GROUP BY p.o_custkey""", exact=["o_custkey"],
          dec_cols={"shp_o_totalprice_skew_e1071": 6, "shp_o_totalprice_kurt_e1071": 6})
def summarise_shape_q(spark, d):
    return A.agg_multi_spec(fx.previous(spark, d), "o_custkey", {"o_totalprice": SHAPE}, "shp", scales=MONEY)


@register("agg_mean_all", f"""SELECT l_suppkey, {_sel(S.spec_sql({c: ['mean'] for c in LI_NUM if c != 'l_suppkey'}, 'sup', scales=MONEY))}
  FROM lineitem GROUP BY l_suppkey""", exact=["l_suppkey"])
def agg_mean_all_q(spark, d):
    li = table(spark, d, "lineitem").drop("l_orderkey", "l_shipdate")
    cols = A.numeric_columns(li, exclude=["l_suppkey"])
    return A.agg_multi_spec(li, "l_suppkey", {c: ["mean"] for c in cols}, "sup", scales=MONEY)


@register("group_count", f"""SELECT o_custkey, count(nullif(o_orderstatus, 'O')) AS prev_status_count FROM {P} p GROUP BY o_custkey""",
          all_exact=True)
def group_count_q(spark, d):
    p = clean.sentinel_to_null(fx.previous(spark, d), {"o_orderstatus": "O"})
    return A.agg_multi_spec(p, "o_custkey", {"o_orderstatus": ["count"]}, "prev").withColumnRenamed(
        "prev_o_orderstatus_count", "prev_status_count")


@register("group_size", f"SELECT l_orderkey, count(*) AS lines_size FROM lineitem GROUP BY l_orderkey", all_exact=True)
def group_size_q(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(A.agg_expr("l_orderkey", "size").alias("lines_size"))


@register("group_nunique", f"""SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_priorities, count(DISTINCT o_orderstatus) AS n_statuses
  FROM orders GROUP BY o_custkey""", all_exact=True)
def group_nunique_q(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(A.agg_expr("o_orderpriority", "nunique").alias("n_priorities"),
                                      A.agg_expr("o_orderstatus", "nunique").alias("n_statuses"))


@register("group_nunique_approx", """SELECT o_custkey, true AS parts_near, true AS suppliers_near
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey""", all_exact=True)
def group_nunique_approx_q(spark, d):
    """Distinct parts and suppliers of a customer from sketches kept by order, within five standard errors of the exact counts."""
    cols = ["l_partkey", "l_suppkey"]
    li, orders = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    by_order = Sk.distinct_sketches(li, "l_orderkey", cols).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    near = Sk.distinct_estimates(Sk.merge_sketches(by_order, "o_custkey", cols), cols)
    exact = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(*[F.count_distinct(c).alias(c) for c in cols])
    ok = {n: F.abs(F.col(f"nunique_{c}") - F.col(c)) <= 0.08 * F.col(c) for n, c in (("parts_near", cols[0]), ("suppliers_near", cols[1]))}
    return near.join(exact, "o_custkey").select("o_custkey", *[v.alias(n) for n, v in ok.items()])


@register("group_ratio_of_counts", """SELECT o_custkey, count(*) / count(DISTINCT o_orderpriority) AS orders_per_priority
  FROM orders GROUP BY o_custkey""", exact=["o_custkey"])
def group_ratio_of_counts_q(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.try_divide(F.count(F.lit(1)), F.count_distinct("o_orderpriority"))
                                      .alias("orders_per_priority"))


@register("conditional_count", """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_completed FROM orders GROUP BY o_custkey""",
          all_exact=True)
def conditional_count_q(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_completed"))


@register("conditional_mean", f"""SELECT o_custkey, avg(CASE WHEN paid_day - due_day > 60 THEN 1 ELSE 0 END) AS share_late,
  avg(CASE WHEN payment < instalment * 0.95 THEN 1 ELSE 0 END) AS share_underpaid FROM {I} i GROUP BY o_custkey""",
          exact=["o_custkey"])
def conditional_mean_q(spark, d):
    i = fx.installments(spark, d)
    return i.groupBy("o_custkey").agg(
        F.avg(clean.compare_flag(F.col("paid_day") - F.col("due_day") > 60)).alias("share_late"),
        F.avg(clean.compare_flag(F.col("payment") < F.col("instalment") * 0.95)).alias("share_underpaid"))


SUB_SPEC = {"o_totalprice": ["max", "mean", "sum"], "day": ["min", "max"], "o_orderkey": ["count"]}
SUBSETS_SQL = {"appr": "o_orderstatus = 'F'", "refu": "o_orderstatus = 'P'"}


def _subsets():
    return dict(SUBSETS_SQL)


def _subset_sql(ratios: bool) -> str:
    items = []
    for prefix, w in SUBSETS_SQL.items():
        items += S.spec_sql(SUB_SPEC, prefix, w, absent_null=True, scales=MONEY)
    inner = f"SELECT o_custkey, {_sel(items)} FROM {P} p GROUP BY o_custkey"
    if not ratios:
        return inner
    rs = [f"appr_{c}_{f} / nullif(refu_{c}_{f}, 0) AS ratio_appr_refu_{c}_{f}" for c, fs in SUB_SPEC.items() for f in fs]
    return f"SELECT *, {_sel(rs)} FROM ({inner}) s"


SUB_EXACT = ["o_custkey"] + [f"{p}_{c}_{f}" for p in SUBSETS_SQL for c, f in
                             [("day", "min"), ("day", "max"), ("o_orderkey", "count")]]


@register("filtered_subset_agg", _subset_sql(False), exact=SUB_EXACT)
def filtered_subset_agg_q(spark, d):
    return A.subset_agg(fx.previous(spark, d), "o_custkey", SUB_SPEC, _subsets(), scales=MONEY)


@register("subset_ratio", _subset_sql(True), exact=SUB_EXACT)
def subset_ratio_q(spark, d):
    return A.subset_agg(fx.previous(spark, d), "o_custkey", SUB_SPEC, _subsets(), ratios=[("appr", "refu")], scales=MONEY)


CHILD_SPEC = {"l_quantity": ["sum", "max"], "l_linenumber": ["size"]}
PARENT_SPEC = {"ord_l_quantity_sum": ["mean", "max"], "ord_l_quantity_max": ["max"], "ord_l_linenumber_size": ["mean", "sum"],
               "o_totalprice": ["mean"]}


@register("two_level_agg", f"""WITH c AS (SELECT l_orderkey, {_sel(S.spec_sql(CHILD_SPEC, 'ord', scales=MONEY))} FROM lineitem GROUP BY l_orderkey),
  j AS (SELECT o.o_custkey, o.o_totalprice, c.* FROM orders o LEFT JOIN c ON o.o_orderkey = c.l_orderkey)
  SELECT o_custkey, {_sel(S.spec_sql(PARENT_SPEC, 'cus', scales={'o_totalprice': 2, 'ord_l_quantity_sum': 2}, int_sums=['ord_l_linenumber_size']))}
  FROM j GROUP BY o_custkey""", exact=["o_custkey", "cus_ord_l_linenumber_size_sum"])
def two_level_agg_q(spark, d):
    return A.two_level_agg(table(spark, d, "lineitem"), table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey"),
                           "l_orderkey", "o_custkey", CHILD_SPEC, "ord", PARENT_SPEC, "cus",
                           child_scales=MONEY, parent_scales={"o_totalprice": 2, "ord_l_quantity_sum": 2})


@register("nested_group_agg", f"""WITH x AS (SELECT o_custkey, l_orderkey, max(payment) AS mx, min(paid_day - due_day) AS mn FROM {I} i GROUP BY ALL)
  SELECT o_custkey, coalesce(sum(mx), 0) AS sum_of_max_payment, CAST(coalesce(sum(mn), 0) AS BIGINT) AS sum_of_min_delay FROM x GROUP BY o_custkey""",
          exact=["o_custkey", "sum_of_min_delay"])
def nested_group_agg_q(spark, d):
    i = fx.installments(spark, d)
    x = i.groupBy("o_custkey", "l_orderkey").agg(F.max("payment").alias("mx"),
                                                 F.min(F.col("paid_day") - F.col("due_day")).alias("mn"))
    return x.groupBy("o_custkey").agg(A.agg_expr("mx", "sum").alias("sum_of_max_payment"),
                                      A.agg_expr("mn", "sum").alias("sum_of_min_delay"))


@register("group_ratio_of_aggs", f"""SELECT o_custkey, max(payment) / nullif(max(instalment), 0) AS max_pay_over_max_inst,
  sum(payment) / nullif(sum(instalment), 0) AS pay_share FROM {I} i GROUP BY o_custkey""", exact=["o_custkey"])
def group_ratio_of_aggs_q(spark, d):
    i = fx.installments(spark, d)
    return i.groupBy("o_custkey").agg(F.try_divide(F.max("payment"), F.max("instalment")).alias("max_pay_over_max_inst"),
                                      F.try_divide(F.sum("payment"), F.sum("instalment")).alias("pay_share"))


@register("group_recipes", f"""WITH g1 AS (SELECT c_mktsegment, c_nationkey, {S.agg('c_acctbal', 'mean', scale=2)} AS grp_c_mktsegment_c_nationkey_c_acctbal_mean,
     max(c_acctbal) AS grp_c_mktsegment_c_nationkey_c_acctbal_max FROM customer GROUP BY ALL),
  g2 AS (SELECT c_mktsegment, median(c_acctbal) AS grp_c_mktsegment_c_acctbal_median, stddev_samp(c_acctbal) AS grp_c_mktsegment_c_acctbal_std
     FROM customer GROUP BY ALL)
  SELECT c.*, g1.* EXCLUDE (c_mktsegment, c_nationkey), g2.* EXCLUDE (c_mktsegment)
  FROM customer c LEFT JOIN g1 USING (c_mktsegment, c_nationkey) LEFT JOIN g2 USING (c_mktsegment)""", exact=[
    "c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
def group_recipes_q(spark, d):
    c = table(spark, d, "customer")
    return G.group_recipes(c, [(["c_mktsegment", "c_nationkey"], [("c_acctbal", "mean"), ("c_acctbal", "max")]),
                               (["c_mktsegment"], [("c_acctbal", "median"), ("c_acctbal", "std")])])


@register("group_broadcast_count", """SELECT c_custkey, count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) AS cnt_seg_nat FROM customer""",
          all_exact=True)
def group_broadcast_count_q(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return G.broadcast_count(c, ["c_mktsegment", "c_nationkey"], "cnt_seg_nat").select("c_custkey", "cnt_seg_nat")


@register("group_broadcast_mean", """SELECT p_partkey, avg(p_retailprice) OVER (PARTITION BY p_brand) AS mean_p_brand_p_retailprice,
  avg(p_size) OVER (PARTITION BY p_brand) AS mean_p_brand_p_size FROM part""", exact=["p_partkey"])
def group_broadcast_mean_q(spark, d):
    p = table(spark, d, "part")
    return G.broadcast_mean(p, "p_brand", ["p_retailprice", "p_size"]).select(
        "p_partkey", "mean_p_brand_p_retailprice", "mean_p_brand_p_size")


@register("group_broadcast_nunique", """WITH b AS (SELECT p_brand, count(DISTINCT p_type) AS nuniq_p_brand_p_type, count(DISTINCT p_size) AS nuniq_p_brand_p_size FROM part GROUP BY ALL),
  t AS (SELECT p_type, count(DISTINCT p_brand) AS nuniq_p_type_p_brand, count(DISTINCT p_size) AS nuniq_p_type_p_size FROM part GROUP BY ALL),
  s AS (SELECT p_size, count(DISTINCT p_brand) AS nuniq_p_size_p_brand, count(DISTINCT p_type) AS nuniq_p_size_p_type FROM part GROUP BY ALL)
  SELECT p.p_partkey, b.* EXCLUDE (p_brand), t.* EXCLUDE (p_type), s.* EXCLUDE (p_size)
  FROM part p LEFT JOIN b USING (p_brand) LEFT JOIN t USING (p_type) LEFT JOIN s USING (p_size)""", all_exact=True)
def group_broadcast_nunique_q(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    out = G.broadcast_nunique(p, ["p_brand", "p_type", "p_size"])
    return out.drop("p_brand", "p_type", "p_size")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("onehot_share_agg", f"""SELECT o_custkey,
  {_sel([f"avg(CASE WHEN o_orderpriority = '{lv}' THEN 1.0 ELSE 0.0 END) AS pri_o_orderpriority_{A.level_name(lv)}_mean" for lv in PRIORITIES])},
  avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) AS pri_o_orderpriority_nan_mean,
  avg(CASE WHEN nullif(o_orderstatus, 'O') = 'F' THEN 1.0 ELSE 0.0 END) AS pri_o_orderstatus_f_mean,
  avg(CASE WHEN nullif(o_orderstatus, 'O') = 'P' THEN 1.0 ELSE 0.0 END) AS pri_o_orderstatus_p_mean,
  avg(CASE WHEN nullif(o_orderstatus, 'O') IS NULL THEN 1.0 ELSE 0.0 END) AS pri_o_orderstatus_nan_mean
  FROM orders GROUP BY o_custkey""", exact=["o_custkey"])
def onehot_share_agg_q(spark, d):
    o = clean.sentinel_to_null(table(spark, d, "orders"), {"o_orderstatus": "O"})
    levels = A.discover_levels(o, ["o_orderpriority", "o_orderstatus"])
    exprs = (A.share_of_levels(o, "o_custkey", "o_orderpriority", levels["o_orderpriority"], "pri")
             + A.share_of_levels(o, "o_custkey", "o_orderstatus", levels["o_orderstatus"], "pri"))
    return o.groupBy("o_custkey").agg(*exprs)


@register("row_missing_count", f"""SELECT c_custkey, (CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) + (CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END)
  + (CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END) AS n_missing FROM {APP} a""", all_exact=True)
def row_missing_count_q(spark, d):
    a = fx.application(spark, d)
    a = clean.outlier_to_null(a, {"c_acctbal": F.col("c_acctbal") < 0})
    a = clean.sentinel_to_null(a, {"c_mktsegment": "HOUSEHOLD", "n_regionkey": 0})
    return a.select("c_custkey", rowstats.row_missing_count(["c_acctbal", "c_mktsegment", "n_regionkey"]).alias("n_missing"))


ROW_COLS = ["l_quantity", "l_extendedprice / 1000.0", "l_discount * 100", "l_tax * 100", "nullif(l_linenumber, 1)"]


def _row_sql() -> str:
    cols = [f"CAST({c} AS DOUBLE)" for c in ROW_COLS]
    lst = f"list_filter([{', '.join(cols)}], x -> x IS NOT NULL)"
    return f"""WITH r AS (SELECT l_orderkey, l_linenumber, {lst} AS v FROM lineitem),
  s AS (SELECT *, len(v) AS n, list_avg(v) AS mu FROM r),
  m AS (SELECT *, list_sum(list_transform(v, x -> pow(x - mu, 2))) AS c2, list_sum(list_transform(v, x -> pow(x - mu, 3))) AS c3,
    list_sum(list_transform(v, x -> pow(x - mu, 4))) AS c4 FROM s)
  SELECT l_orderkey, l_linenumber, mu AS rs_mean,
    CASE WHEN n >= 2 THEN sqrt(c2 / (n - 1)) END AS rs_std, coalesce(list_sum(v), 0) AS rs_sum,
    list_median(v) AS rs_median, list_min(v) AS rs_min, list_max(v) AS rs_max,
    CASE WHEN n >= 3 AND c2 > 0 THEN (c3 / n) / pow(c2 / n, 1.5) * sqrt(n * (n - 1)) / (n - 2) END AS rs_skew,
    CASE WHEN n >= 4 AND c2 > 0 THEN (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * ((c4 / n) / pow(c2 / n, 2) - 3) + 6) END AS rs_kurt
  FROM m"""


@register("row_stats", _row_sql().replace("x -> ", "lambda x: "), exact=["l_orderkey", "l_linenumber"],
          dec_cols={"rs_skew": 6, "rs_kurt": 6}, sig_cols={"rs_std": 8})
def row_stats_q(spark, d):
    li = table(spark, d, "lineitem")
    cols = [F.expr(c).cast("double") for c in ROW_COLS]
    return li.select("l_orderkey", "l_linenumber",
                     *rowstats.row_stats(cols, ["mean", "std", "sum", "median", "min", "max", "skew", "kurt"], "rs"))


@register("row_flag_sum", """SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) + CAST(l_linestatus = 'F' AS INTEGER)
  + CAST(l_discount > 0.05 AS INTEGER) AS n_flags FROM lineitem""", all_exact=True)
def row_flag_sum_q(spark, d):
    li = table(spark, d, "lineitem")
    flags = [clean.compare_flag(F.col("l_returnflag") == "R"), clean.compare_flag(F.col("l_linestatus") == "F"),
             clean.compare_flag(F.col("l_discount") > 0.05)]
    return li.select("l_orderkey", "l_linenumber", rowstats.row_flag_sum(flags).alias("n_flags"))


@register("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders", all_exact=True)
def distinct_rows_q(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


def _reason_sql(flags: bool) -> str:
    if flags:
        cols = _sel([f"max(CASE WHEN o_orderpriority = '{r}' THEN 1 ELSE 0 END) AS last_refused_{A.level_name(r)}" for r in PRIORITIES])
        return f"""WITH r AS (SELECT * FROM {P} p WHERE o_orderstatus = 'P'),
  l AS (SELECT * FROM r WHERE day = (SELECT max(day) FROM r r2 WHERE r2.o_custkey = r.o_custkey))
  SELECT o_custkey, {cols} FROM l GROUP BY o_custkey"""
    cols = _sel([f"count(*) FILTER (WHERE o_orderpriority = '{r}') AS refused_{A.level_name(r)}" for r in PRIORITIES])
    return f"SELECT o_custkey, {cols} FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey"


@register("reason_flags", _reason_sql(True), all_exact=True)
def reason_flags_q(spark, d):
    """For each customer's latest refused application(s): one flag per reason."""
    r = fx.previous(spark, d).where(F.col("o_orderstatus") == "P")
    last = O.extreme_rows(r, "o_custkey", "day", "max")
    return last.groupBy("o_custkey").agg(*[F.max(clean.compare_flag(F.col("o_orderpriority") == lv))
                                           .alias(f"last_refused_{A.level_name(lv)}") for lv in PRIORITIES])


@register("reason_counts", _reason_sql(False), all_exact=True)
def reason_counts_q(spark, d):
    r = table(spark, d, "orders").where(F.col("o_orderstatus") == "P")
    return r.groupBy("o_custkey").agg(*[F.count_if(F.col("o_orderpriority") == lv).alias(f"refused_{A.level_name(lv)}")
                                        for lv in PRIORITIES])
