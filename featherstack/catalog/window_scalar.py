"""§2.5 ordered history, §2.6 sorts, §2.7 set operations, §2.8 scalar
functions and §2.10 the UDF surface."""

from __future__ import annotations

import pandas as pd
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import functions as F

from ..functions import clean, scalar
from ..models.transformer import GlobalCentering, GlobalCenteringModel, RatioFeatures
from ..operators import blend as B
from ..operators import ordered as O
from ..operators.agg import agg_expr
from ..operators.grouped import grouped_apply
from ..operators.rank import global_quantiles
from ..plans import fixture as fx
from ..sources import sinks
from ..sources.tables import split_train_test, union_train_test
from . import sqlgen as S
from .common import register, table
from .joins_agg import _sel

P, I, E, APP = fx.PREVIOUS_SQL, fx.INSTALLMENTS_SQL, fx.EVENTS_SQL, fx.APPLICATION_SQL


def _event_order_desc():
    return [F.col("ts").desc(), F.col("event_id").desc()]


# ---------------------------------------------------------------- 2.5 ordered history
@register("last_value_per_group", f"""SELECT o_custkey,
  arg_max(o_totalprice, (day, o_orderkey)) FILTER (WHERE o_totalprice IS NOT NULL) AS last_o_totalprice_last,
  arg_max(nullif(o_orderpriority, '5-LOW'), (day, o_orderkey)) FILTER (WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL) AS last_o_orderpriority_last
  FROM {P} p GROUP BY o_custkey""", exact=["o_custkey", "last_o_orderpriority_last"])
def last_value_per_group_q(spark, d):
    """Latest non-missing value per customer (pandas ``.last()`` after a sort)."""
    p = clean.sentinel_to_null(fx.previous(spark, d), {"o_orderpriority": "5-LOW"})
    return O.last_values(p, "o_custkey", ["day", "o_orderkey"], ["o_totalprice", "o_orderpriority"], "last")


@register("first_last_status", f"""SELECT user_id, arg_min(event_type, (ts, event_id)) AS st_event_type_first,
  arg_max(event_type, (ts, event_id)) AS st_event_type_last FROM {E} e GROUP BY user_id""", all_exact=True)
def first_last_status_q(spark, d):
    return O.first_last(fx.events(spark, d), "user_id", ["ts", "event_id"], ["event_type"], "st")


LASTK = [1, 3, 8]


@register("last_k_agg", f"""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {E} e)
  SELECT user_id, {_sel([f"{S.agg('value', 'mean', f'rn <= {k}', scale=2)} AS ev_last{k}_value_mean, max(value) FILTER (WHERE rn <= {k}) AS ev_last{k}_value_max" for k in LASTK])}
  FROM r GROUP BY user_id""", exact=["user_id"])
def last_k_agg_q(spark, d):
    return O.last_k_agg(fx.events(spark, d), "user_id", _event_order_desc(), {"value": ["mean", "max"]}, LASTK, "ev",
                        salt_cols=["event_id"], scales={"value": 2})


@register("nth_latest_agg", f"""WITH dd AS (SELECT o_custkey, day, dense_rank() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS dr FROM {P} p)
  SELECT p.o_custkey, count(*) AS second_size, {S.agg('o_totalprice', 'sum', scale=2)} AS second_o_totalprice_sum
  FROM {P} p JOIN (SELECT DISTINCT o_custkey, day FROM dd WHERE dr = 2) s USING (o_custkey, day) GROUP BY p.o_custkey""",
          exact=["o_custkey", "second_size"])
def nth_latest_agg_q(spark, d):
    """Aggregate over the rows at the second-latest decision day."""
    rows = O.nth_latest_rows(fx.previous(spark, d), "o_custkey", "day", 2)
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("second_size"),
                                         agg_expr("o_totalprice", "sum", scale=2).alias("second_o_totalprice_sum"))


@register("lagged_diff_mean", f"""WITH x AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dv,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {E} e)
  SELECT user_id, avg(dv) AS diff_mean_pandas, avg(CASE WHEN rn = 1 THEN 0.0 ELSE dv END) AS diff_mean_r FROM x GROUP BY user_id""",
          exact=["user_id"], dec_cols={"diff_mean_pandas": 8, "diff_mean_r": 8})
def lagged_diff_mean_q(spark, d):
    e = fx.events(spark, d).withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    return O.lagged_diff_mean(e, "user_id", "t", "event_id", "value",
                              {"null": "diff_mean_pandas", "zero": "diff_mean_r"})


@register("trend_fit", f"""SELECT o_custkey,
  CASE WHEN var_pop(day) FILTER (WHERE day > -1500) > 0 THEN regr_slope(o_totalprice, day) FILTER (WHERE day > -1500) END AS tr_o_totalprice_slope,
  CASE WHEN var_pop(day) FILTER (WHERE day > -1500) > 0 THEN regr_intercept(o_totalprice, day) FILTER (WHERE day > -1500)
       ELSE avg(o_totalprice) FILTER (WHERE day > -1500) END AS tr_o_totalprice_intercept
  FROM {P} p GROUP BY o_custkey""", exact=["o_custkey"], sig=8)
def trend_fit_q(spark, d):
    """Per-customer line fit of amount on day inside a horizon of 1500 days."""
    return O.trend_fit(fx.previous(spark, d), "o_custkey", "o_totalprice", "day", "tr", where=F.col("day") > -1500)


@register("trend_last_k", f"""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {E} e)
  SELECT user_id, {_sel([f"CASE WHEN var_pop({k} + 1 - rn) FILTER (WHERE rn <= {k}) > 0 THEN regr_slope(value, {k} + 1 - rn) FILTER (WHERE rn <= {k}) END AS tk_last{k}_value_slope" for k in (8, 16)])}
  FROM r GROUP BY user_id""", exact=["user_id"], sig=8)
def trend_last_k_q(spark, d):
    return O.trend_last_k(fx.events(spark, d), "user_id", _event_order_desc(), "value", [8, 16], "tk", salt_cols=["event_id"])


SHAPE_K = ["sum", "mean", "max", "std", "skew", "kurt"]


@register("last_k_shape", f"""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {E} e)
  SELECT user_id, {_sel(S.spec_sql({'value': SHAPE_K}, 'sh_last8', 'rn <= 8', scales={'value': 2}))} FROM r GROUP BY user_id""",
          exact=["user_id"], dec_cols={"sh_last8_value_skew": 6, "sh_last8_value_kurt": 6})
def last_k_shape_q(spark, d):
    return O.last_k_agg(fx.events(spark, d), "user_id", _event_order_desc(), {"value": SHAPE_K}, [8], "sh",
                        salt_cols=["event_id"], scales={"value": 2})


@register("running_extreme_filter", f"""SELECT o_custkey, l_orderkey, l_linenumber, due_day FROM {I} i
  WHERE due_day = (SELECT min(due_day) FROM {I} j WHERE j.o_custkey = i.o_custkey)""", all_exact=True)
def running_extreme_filter_q(spark, d):
    i = fx.installments(spark, d).select("o_custkey", "l_orderkey", "l_linenumber", "due_day")
    return O.extreme_rows(i, "o_custkey", "due_day", "min")


@register("rank_normalise_avg", """SELECT doc_id, (1 + rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0)
  / (count(*) OVER () + 1) AS n_chars_rank FROM documents""", exact=["doc_id"])
def rank_normalise_avg_q(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return B.rank_normalise(docs, "n_chars", "n_chars_rank").select("doc_id", "n_chars_rank")


BLEND_SQL = """WITH s AS (SELECT doc_id, n_chars % 7 AS m0, n_chars % 11 AS m1, length(lang) + n_chars % 3 AS m2 FROM documents)
  SELECT doc_id, (rank() OVER (ORDER BY m0) + rank() OVER (ORDER BY m1) + rank() OVER (ORDER BY m2)) / 3.0 / count(*) OVER () AS blend
  FROM s"""


def _blend_input(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", (F.col("n_chars") % 7).alias("m0"), (F.col("n_chars") % 11).alias("m1"),
                       (F.length("lang") + F.col("n_chars") % 3).alias("m2"))


@register("rank_min_blend", BLEND_SQL, exact=["doc_id"])
def rank_min_blend_q(spark, d):
    """Min-rank of each model column (heavy ties), averaged, over n."""
    return B.rank_average(_blend_input(spark, d), ["m0", "m1", "m2"], "blend", "min", key="doc_id").select("doc_id", "blend")


# ---------------------------------------------------------------- 2.6 sorts
@register("sort_by_keys", f"SELECT user_id, ts, event_id, value FROM {E} e ORDER BY user_id, ts, event_id", exact=[
    "user_id", "ts", "event_id"])
def sort_by_keys_q(spark, d):
    return fx.events(spark, d).select("user_id", "ts", "event_id", "value").orderBy("user_id", "ts", "event_id")


@register("sort_desc_topk_per_group", """SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS INTEGER) AS rn FROM orders) WHERE rn <= 3""",
          exact=["o_custkey", "o_orderkey", "rn"])
def sort_desc_topk_per_group_q(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return O.top_k_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey").desc()], 3,
                             salt_cols=["o_orderkey"])


@register("head_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5", exact=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
def head_rows_q(spark, d):
    return table(spark, d, "orders").orderBy("o_orderkey").limit(5)


# ---------------------------------------------------------------- 2.7 set operations
@register("union_train_test", f"""SELECT c_custkey, c_acctbal, c_mktsegment, (c_acctbal > 0)::INTEGER AS target, true AS is_train
  FROM {APP} a WHERE is_train UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, NULL, false FROM {APP} b WHERE NOT is_train""",
          exact=["c_custkey", "c_mktsegment", "target", "is_train"])
def union_train_test_q(spark, d):
    app = fx.application(spark, d)
    train = app.where("is_train").select("c_custkey", "c_acctbal", "c_mktsegment",
                                         (F.col("c_acctbal") > 0).cast("int").alias("target"))
    test = app.where(~F.col("is_train")).select("c_custkey", "c_acctbal", "c_mktsegment")
    return union_train_test(train, test)


@register("split_train_test", f"SELECT c_custkey, c_acctbal FROM {APP} a WHERE NOT is_train", exact=["c_custkey"])
def split_train_test_q(spark, d):
    _, test = split_train_test(fx.application(spark, d))
    return test.select("c_custkey", "c_acctbal")


@register("column_set_difference", "SELECT o_orderkey, o_orderdate FROM orders", all_exact=True)
def column_set_difference_q(spark, d):
    """Columns of orders not present in the derived previous-application view (plus the key)."""
    from ..operators.joins import column_set_difference
    o = table(spark, d, "orders")
    only = column_set_difference(o, fx.previous(spark, d))
    return o.select("o_orderkey", *only)


# ---------------------------------------------------------------- 2.8 scalar functions
@register("ratio_features", f"""SELECT o_custkey, l_orderkey, l_linenumber, payment / nullif(instalment, 0) AS pay_ratio,
  instalment - payment AS pay_diff, payment / nullif(1 + (paid_day - due_day), 0) AS pay_per_day,
  (instalment + payment) * 0.5 - 2 * payment AS weighted FROM {I} i""", exact=["o_custkey", "l_orderkey", "l_linenumber"])
def ratio_features_q(spark, d):
    i = fx.installments(spark, d)
    return i.select("o_custkey", "l_orderkey", "l_linenumber",
                    scalar.safe_div("payment", "instalment").alias("pay_ratio"),
                    (F.col("instalment") - F.col("payment")).alias("pay_diff"),
                    scalar.safe_div("payment", 1 + (F.col("paid_day") - F.col("due_day"))).alias("pay_per_day"),
                    ((F.col("instalment") + F.col("payment")) * 0.5 - 2 * F.col("payment")).alias("weighted"))


@register("transform_log_sqrt", """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END AS acct_sqrt,
  CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END AS acct_log1p, abs(c_acctbal) AS acct_abs,
  round(c_acctbal / 3) AS acct_round FROM customer""", exact=["c_custkey"])
def transform_log_sqrt_q(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", scalar.safe_sqrt("c_acctbal").alias("acct_sqrt"),
                    scalar.safe_log1p("c_acctbal").alias("acct_log1p"), F.abs("c_acctbal").alias("acct_abs"),
                    F.round(F.col("c_acctbal") / 3).alias("acct_round"))


@register("safe_div", """SELECT c_custkey, coalesce(c_acctbal / nullif(c_nationkey % 3, 0), 0.0) AS acct_per_group FROM customer""",
          exact=["c_custkey"])
def safe_div_q(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", scalar.safe_div_zero("c_acctbal", F.col("c_nationkey") % 3).alias("acct_per_group"))


@register("positive_part", f"""SELECT o_custkey, l_orderkey, l_linenumber, greatest(paid_day - due_day - 30, 0) AS dpd,
  greatest(due_day + 30 - paid_day, 0) AS dbd,
  CASE WHEN nullif(paid_day - due_day, 45) IS NOT NULL THEN greatest(nullif(paid_day - due_day, 45) - 30, 0) END AS dpd_keep_missing
  FROM {I} i""", all_exact=True)
def positive_part_q(spark, d):
    i = fx.installments(spark, d)
    delay = F.col("paid_day") - F.col("due_day")
    gapped = F.when(delay != 45, delay)
    return i.select("o_custkey", "l_orderkey", "l_linenumber", scalar.positive_part(delay - 30).alias("dpd"),
                    scalar.positive_part(30 - delay).alias("dbd"),
                    scalar.positive_part(gapped - 30, keep_null=True).alias("dpd_keep_missing"))


@register("centre_by_global", """SELECT c_custkey, c_acctbal - (SELECT avg(c_acctbal) FROM customer) AS acct_minus_mean,
  c_acctbal - (SELECT median(c_acctbal) FROM customer) AS acct_minus_median FROM customer""", exact=["c_custkey"], sig=9)
def centre_by_global_q(spark, d):
    c = table(spark, d, "customer")
    mean = c.agg(F.avg("c_acctbal")).first()[0]
    median = global_quantiles(c, ["c_acctbal"], [0.5])["c_acctbal"][0]
    return c.select("c_custkey", (F.col("c_acctbal") - F.lit(mean)).alias("acct_minus_mean"),
                    (F.col("c_acctbal") - F.lit(median)).alias("acct_minus_median"))


@register("safe_int", """SELECT event_id, coalesce(TRY_CAST(trim(split_part(props, ':', 2), ' }') AS INTEGER), 0) AS k,
  coalesce(TRY_CAST(event_type AS INTEGER), 0) AS bad FROM events""", all_exact=True)
def safe_int_q(spark, d):
    e = table(spark, d, "events")
    raw = F.trim(F.split_part(F.col("props"), F.lit(":"), F.lit(2)), F.lit(" }"))
    return e.select("event_id", scalar.safe_int(raw).alias("k"), scalar.safe_int("event_type").alias("bad"))


@register("ifelse", """SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END, 0)
  + coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey % 4 END, 0) AS counters,
  CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'mid' ELSE 'low' END AS band FROM customer""", all_exact=True)
def ifelse_q(spark, d):
    c = table(spark, d, "customer")
    a = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    b = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey") % 4)
    return c.select("c_custkey", (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias("counters"),
                    F.when(F.col("c_acctbal") > 5000, "high").when(F.col("c_acctbal") > 0, "mid").otherwise("low").alias("band"))


@register("string", """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment AS nation_segment FROM customer""",
          all_exact=True)
def string_q(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.concat_ws("_", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("nation_segment"))


@register("date", """SELECT o_orderkey, CAST(date_diff('day', DATE '2001-08-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
  CAST((year(o_orderdate) - 2001) * 12 + month(o_orderdate) - 8 AS INTEGER) AS months FROM orders""", all_exact=True)
def date_q(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", scalar.relative_day("o_orderdate", fx.ORDER_ANCHOR).alias("days"),
                    ((F.year("o_orderdate") - 2001) * 12 + F.month("o_orderdate") - 8).cast("int").alias("months"))


# ---------------------------------------------------------------- 2.10 UDF surface
def _history_last(rows: pd.DataFrame) -> tuple[pd.DataFrame, DataFrameGroupBy]:
    """Each customer's last row, by customer, and the customers' groups in the same order."""
    rows = rows.sort_values(["o_custkey", "day", "o_orderkey"], kind="stable")
    return rows.drop_duplicates("o_custkey", keep="last"), rows.groupby("o_custkey", dropna=False, sort=False)


def _history_part(pdf: pd.DataFrame) -> pd.DataFrame:
    last, group = _history_last(pdf)
    return pd.DataFrame({"o_custkey": last["o_custkey"].array, "n": group.size().array, "first_day": group["day"].min().array,
                         "last_day": group["day"].max().array, "day": last["day"].array, "o_orderkey": last["o_orderkey"].array,
                         "price": last["o_totalprice"].array})


def _history_merge(parts: pd.DataFrame) -> pd.DataFrame:
    last, group = _history_last(parts)
    return pd.DataFrame({"o_custkey": last["o_custkey"].array, "ga_size": group["n"].sum().array, "ga_last_price": last["price"].array,
                         "ga_span_days": group["last_day"].max().array - group["first_day"].min().array})


@register("grouped_apply", f"""SELECT o_custkey, count(*) AS ga_size, arg_max(o_totalprice, (day, o_orderkey)) AS ga_last_price,
  max(day) - min(day) AS ga_span_days FROM {P} p GROUP BY o_custkey""", exact=["o_custkey", "ga_size", "ga_span_days"])
def grouped_apply_q(spark, d):
    p = fx.previous(spark, d).select("o_custkey", "o_orderkey", "day", "o_totalprice")
    return grouped_apply(p, "o_custkey", _history_part, _history_merge,
                         "o_custkey long, n long, first_day int, last_day int, day int, o_orderkey long, price double",
                         "o_custkey long, ga_size long, ga_last_price double, ga_span_days int", many=True)


@register("grouped_lambda_ratio", f"""SELECT o_custkey, max(payment) / nullif(max(instalment), 0) AS max_ratio FROM {I} i GROUP BY o_custkey""",
          exact=["o_custkey"])
def grouped_lambda_ratio_q(spark, d):
    i = fx.installments(spark, d)
    return i.groupBy("o_custkey").agg(F.try_divide(F.max("payment"), F.max("instalment")).alias("max_ratio"))


@register("rowwise_apply", """SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice * l_discount > 1000 THEN l_extendedprice * l_discount ELSE 0 END AS big_discount
  FROM lineitem""", exact=["l_orderkey", "l_linenumber"])
def rowwise_apply_q(spark, d):
    li = table(spark, d, "lineitem")
    x = F.col("l_extendedprice") * F.col("l_discount")
    return li.select("l_orderkey", "l_linenumber", F.when(x > 1000, x).otherwise(F.lit(0.0)).alias("big_discount"))


@register("feature_transformer", """SELECT *, c_acctbal / nullif(c_nationkey, 0) AS c_acctbal_over_c_nationkey,
  c_acctbal - (SELECT avg(c_acctbal) FROM customer) AS c_acctbal_centred FROM customer""",
          exact=["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], sig=8)
def feature_transformer_q(spark, d):
    """Fit, persist, reload and apply feature objects (Spark ML stages)."""
    c = table(spark, d, "customer")
    path = sinks.scratch_path(spark, "transformers")
    ratios = RatioFeatures(pairs=["c_acctbal/c_nationkey"])
    ratios.save(f"{path}/ratios")
    centre = GlobalCentering(inputCols=["c_acctbal"]).fit(c)
    centre.save(f"{path}/centre")
    out = RatioFeatures.load(f"{path}/ratios").transform(c)
    return GlobalCenteringModel.load(f"{path}/centre").transform(out)


