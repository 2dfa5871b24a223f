"""§2.14 composite feature families, the assembled training table, the OOF
matrix and the stacker."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import oof, selection
from ..operators import blend as B
from ..operators import metrics as M
from ..operators.agg import level_name
from ..plans import features as FT
from ..plans import fixture as fx
from ..sources import sinks
from . import sqlgen as S
from .common import register, table
from .joins_agg import _PRED_SQL, _long_predictions, _sel, wide_predictions

P, L, I, E, APP = fx.PREVIOUS_SQL, fx.LINES_SQL, fx.INSTALLMENTS_SQL, fx.EVENTS_SQL, fx.APPLICATION_SQL
MONEY = FT.MONEY

APP_BASE_SQL = f"""(SELECT c_custkey, is_train, c_mktsegment, n_regionkey, c_acctbal AS income,
  CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey / 24.0 END AS ext1, n_regionkey / 4.0 AS ext2,
  CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 100) / 100.0 END AS ext3,
  -(c_custkey % 20000) - 7000 AS days_birth,
  CASE WHEN c_custkey % 13 = 0 THEN 365243 ELSE -(c_custkey % 3000) END AS days_employed,
  c_nationkey % 4 AS children FROM {APP} app)"""
APP_CLEAN_SQL = f"(SELECT * REPLACE (CASE WHEN days_employed = 365243 THEN NULL ELSE days_employed END AS days_employed) FROM {APP_BASE_SQL} b)"


def _present(cols):
    return " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)


def _rsum(cols):
    return "(" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols) + ")"


def _central(cols, mean, p):
    return "(" + " + ".join(f"coalesce(pow(CAST({c} AS DOUBLE) - {mean}, {p}), 0.0)" for c in cols) + ")"


EXT = ["ext1", "ext2", "ext3"]
RATIOS_SQL = f"""SELECT c_custkey, income / nullif(children + 1, 0) AS income_per_child,
  days_employed / nullif(days_birth, 0) AS employed_to_birth, income / nullif(days_birth, 0) AS income_per_day_age,
  least(ext1, ext2, ext3) AS ext_min, greatest(ext1, ext2, ext3) AS ext_max, {_rsum(EXT)} AS ext_sum,
  {_rsum(EXT)} / nullif({_present(EXT)}, 0) AS ext_mean,
  list_median(list_filter([ext1, ext2, ext3], lambda x: x IS NOT NULL)) AS ext_median,
  CASE WHEN {_present(EXT)} >= 2 THEN sqrt({_central(EXT, f'({_rsum(EXT)} / nullif({_present(EXT)}, 0))', 2)} / ({_present(EXT)} - 1)) END AS ext_std,
  CAST(coalesce(days_birth / -365.25 < 30, false) AS INTEGER) AS young_flag,
  CAST(days_employed IS NULL AS INTEGER) AS employed_missing,
  income / (children + 2) AS income_per_person, children / (children + 2) AS child_share, children + 2 AS family_size,
  income / nullif(days_employed, 0) AS income_per_day_employed, days_employed - days_birth AS days_before_work,
  (days_employed - days_birth) / nullif(days_birth, 0) AS before_work_to_birth,
  days_birth / -365.25::DOUBLE AS age_years, days_employed / -365.25::DOUBLE AS work_years,
  ext1 * 2 + ext2 * 3 + ext3 * 4 AS ext_weighted, ext1 * ext2 * ext3 AS ext_prod, ext1 / nullif(ext2 + ext3, 0) AS ext1_to_rest,
  CAST(3 - ({_present(EXT)}) AS INTEGER) AS ext_missing,
  CAST(days_birth < -14000 AS INTEGER) AS retirement_age_flag, CAST(coalesce(days_employed < -2000, false) AS INTEGER) AS long_employment_flag,
  CAST(coalesce(children > 2 AND income < 1000, false) AS INTEGER) AS large_poor_family_flag,
  CAST(coalesce(income < 0, false) AS INTEGER) AS negative_income_flag, CASE WHEN income > 0 THEN ln(1 + income) END AS log_income
  FROM {APP_CLEAN_SQL} a"""
RATIOS_EXACT = ["c_custkey", "young_flag", "employed_missing", "family_size", "days_before_work", "ext_missing", "retirement_age_flag",
                "long_employment_flag", "large_poor_family_flag", "negative_income_flag"]


@register("features_application_ratios", RATIOS_SQL, exact=RATIOS_EXACT)
def features_application_ratios_q(spark, d):
    return FT.features_application_ratios(spark, d)


K4 = ["ext1", "ext2", "ext3", "income"]


def _row_kurt_sql(cols):
    n = f"CAST({_present(cols)} AS DOUBLE)"
    mean = f"({_rsum(cols)} / nullif({_present(cols)}, 0))"
    m2 = f"({_central(cols, mean, 2)} / {n})"
    m4 = f"({_central(cols, mean, 4)} / {n})"
    g2 = f"(CASE WHEN {m2} > 0 THEN {m4} / pow({m2}, 2) - 3 END)"
    return f"CASE WHEN {n} >= 4 THEN ({n} - 1) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * {g2} + 6) END"


NEW_SQL = f"""WITH a AS {APP_CLEAN_SQL},
  s AS (SELECT avg(income) AS mi, median(income) AS md FROM a),
  b AS (SELECT c_custkey, c_mktsegment, n_regionkey, income, ext1, ext2, ext3,
    (ext1 + ext2) / nullif(ext3 + 1, 0) AS new_ext_ratio,
    CAST(ext1 IS NULL AS INTEGER) + CAST(ext3 IS NULL AS INTEGER) + CAST(days_employed IS NULL AS INTEGER) AS new_flag_sum,
    {_row_kurt_sql(K4)} AS new_row_kurt, income - mi AS new_income_centred_mean, income - md AS new_income_centred_median
    FROM a, s),
  g AS (SELECT c_mktsegment, n_regionkey, median(income) AS grp_c_mktsegment_n_regionkey_income_median,
    avg(ext2) AS grp_c_mktsegment_n_regionkey_ext2_mean FROM b GROUP BY ALL),
  e AS (SELECT list_sort(list_distinct(quantile_cont(income, [{', '.join(repr(i / 16) for i in range(17))}]))) AS edges FROM b),
  i AS (SELECT list_slice(edges, 2, len(edges) - 1) AS inner_edges FROM e)
  SELECT b.* EXCLUDE (c_mktsegment, n_regionkey), g.grp_c_mktsegment_n_regionkey_income_median, g.grp_c_mktsegment_n_regionkey_ext2_mean,
    CAST(len(list_filter(inner_edges, lambda x: x < income)) AS INTEGER) AS new_income_bin, true AS new_ext3_cluster
  FROM b LEFT JOIN g USING (c_mktsegment, n_regionkey), i"""


def _clustered(df):
    """The k-means id, which SQL can't know, as whether it is one of the four."""
    return df.withColumn("new_ext3_cluster", F.col("new_ext3_cluster").between(0, 3))


@register("features_application_new", NEW_SQL, exact=["c_custkey", "new_flag_sum", "new_income_bin", "new_ext3_cluster"],
          dec_cols={"new_row_kurt": 6})
def features_application_new_q(spark, d):
    return _clustered(FT.features_application_new(spark, d))


PRODUCTS_SQL = f"""SELECT c_custkey, {_sel([f"{x} * {y} AS {x}_x_{y}" for x, y in FT.PAIRS])}, ext1 * ext2 * ext3 AS ext_product,
  {_sel([f"{x} / nullif({y}, 0) AS {x}_over_{y}" for x, y in FT.PAIRS])}, {_sel([f"income / nullif({x}, 0) AS income_over_{x}" for x in FT.SCORES])},
  {_sel([f"income * {x} AS income_x_{x}" for x in FT.SCORES])}, {_sel([f"{x} / nullif(days_birth, 0) AS {x}_over_age" for x in FT.SCORES])},
  days_employed / nullif(ext2, 0) AS employed_over_ext2 FROM {APP_CLEAN_SQL} a"""


@register("features_application_products", PRODUCTS_SQL, exact=["c_custkey"])
def features_application_products_q(spark, d):
    return FT.features_application_products(spark, d)


CONTEST_SQL = f"""WITH a AS (SELECT * REPLACE (CASE WHEN income > 9000 THEN NULL ELSE income END AS income) FROM {APP_CLEAN_SQL} x)
  SELECT c_custkey,
    CASE WHEN income / nullif(children + 1, 0) > -1 THEN ln(1 + income / nullif(children + 1, 0)) END AS log_income_per_child,
    sqrt(abs(days_birth)) AS sqrt_age_days, CASE WHEN children * 3 > 6 THEN 6 ELSE children * 3 END AS capped_children3,
    CAST(coalesce(ext1 > 0.5, false) AS INTEGER) + CAST(coalesce(ext3 > 0.5, false) AS INTEGER)
      + CAST(coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY'), false) AS INTEGER) AS flag_sum,
    coalesce(ext1, 0.0) + coalesce(ext3, 0.0) AS ext13_counter,
    CAST(ext1 IS NULL AS INTEGER) + CAST(ext3 IS NULL AS INTEGER) + CAST(income IS NULL AS INTEGER) + CAST(days_employed IS NULL AS INTEGER) AS n_missing,
    CASE WHEN days_employed IS NOT NULL THEN greatest(days_employed + 1000, 0) END AS recent_job_days
  FROM a"""


@register("features_application_contest_r", CONTEST_SQL,
          exact=["c_custkey", "capped_children3", "flag_sum", "n_missing", "recent_job_days"])
def features_application_contest_r_q(spark, d):
    return FT.features_application_contest_r(spark, d)


# ---------------------------------------------------------------- bureau families
def _bureau_sql() -> str:
    bb = f"""SELECT l_orderkey, min(ship_day) AS bb_ship_day_min, max(ship_day) AS bb_ship_day_max, count(*) AS bb_ship_day_size,
      median(ship_day) AS bb_ship_day_median,
      {_sel([f"median(CASE WHEN l_returnflag = '{f}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bb_l_returnflag_{f.lower()}_median" for f in 'ANR'])}
      FROM {L} l GROUP BY l_orderkey"""
    cat = {"bb_l_returnflag_a_median": ["median"], "bb_l_returnflag_r_median": ["median"]}
    ints = ["bb_ship_day_size"]
    items_all = S.spec_sql({**FT.BUREAU_NUM, **cat}, "buro", scales=MONEY, int_sums=ints)
    subs = {"active": "o_orderstatus = 'O'", "closed": "o_orderstatus = 'F'"}
    items_sub = []
    for pre, w in subs.items():
        items_sub += S.spec_sql(FT.BUREAU_NUM, pre, w, absent_null=True, scales=MONEY, int_sums=ints)
    ratios = [f"active_{c}_{f} / nullif(closed_{c}_{f}, 0) AS new_ratio_active_closed_{c}_{f}"
              for c, fs in FT.BUREAU_NUM.items() for f in fs]
    return f"""WITH bb AS ({bb}),
  bureau AS (SELECT p.*, bb.* EXCLUDE (l_orderkey) FROM {P} p LEFT JOIN bb ON p.o_orderkey = bb.l_orderkey),
  s AS (SELECT o_custkey, {_sel(items_all + items_sub)} FROM bureau GROUP BY o_custkey)
  SELECT *, {_sel(ratios)} FROM s"""


def _bureau_exact():
    out = ["o_custkey"]
    for pre in ("buro", "active", "closed"):
        out += [f"{pre}_day_min", f"{pre}_day_max", f"{pre}_bb_ship_day_min_min", f"{pre}_bb_ship_day_max_max",
                f"{pre}_bb_ship_day_size_sum"]
    return out


@register("features_bureau_two_level", _bureau_sql(), exact=_bureau_exact())
def features_bureau_two_level_q(spark, d):
    return FT.features_bureau_two_level(spark, d)


SUMMARY_EXACT = ["o_custkey", "bureau_count", "bureau_types", "last_day", "prolonged_sum"]
SUMMARY_SQL = f"""SELECT o_custkey, count(*) AS bureau_count, count(DISTINCT o_orderpriority) AS bureau_types,
  count(*) / count(DISTINCT o_orderpriority) AS loans_per_type,
  avg(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS active_share,
  {S.agg('o_totalprice', 'sum', "o_orderstatus = 'O'", 2)} AS active_amount_sum,
  {S.agg('o_totalprice', 'sum', "o_orderstatus = 'O'", 2)} / nullif({S.agg('o_totalprice', 'sum', None, 2)}, 0) AS active_amount_share,
  max(day) AS last_day,
  {S.agg('o_totalprice', 'sum', "o_orderstatus = 'P'", 2)} / nullif({S.agg('o_totalprice', 'sum', "o_orderstatus = 'O'", 2)}, 0) AS overdue_to_debt,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS prolonged_sum, avg(CASE WHEN day > -365 THEN 1 ELSE 0 END) AS recent_share
  FROM {P} p GROUP BY o_custkey"""


@register("features_bureau_summary", SUMMARY_SQL, exact=SUMMARY_EXACT)
def features_bureau_summary_q(spark, d):
    return FT.features_bureau_summary(spark, d)


STATUS_ORDER = "(ship_day, l_linenumber, l_partkey)"


STATUS_SQL = f"""WITH po AS (SELECT l_orderkey, arg_min(l_linestatus, {STATUS_ORDER}) AS status_first,
    arg_max(l_linestatus, {STATUS_ORDER}) AS status_last, max(ship_day) - min(ship_day) AS span_days,
    min(ship_day) FILTER (WHERE l_linestatus = 'F') AS closing_day FROM {L} l GROUP BY l_orderkey)
  SELECT o.o_custkey, avg(CAST(coalesce(status_first = 'F', false) AS INTEGER)) AS first_closed_share,
    avg(CAST(coalesce(status_last = 'F', false) AS INTEGER)) AS last_closed_share,
    avg(span_days) AS span_days_mean, max(span_days) AS span_days_max, min(closing_day) AS closing_day_min
  FROM orders o JOIN po ON o.o_orderkey = po.l_orderkey GROUP BY o.o_custkey"""


@register("features_bureau_status", STATUS_SQL, exact=["o_custkey", "span_days_max", "closing_day_min"])
def features_bureau_status_q(spark, d):
    return FT.features_bureau_status(spark, d)


# ---------------------------------------------------------------- previous-application families
def _prev_sql() -> str:
    shares = [f"avg(CASE WHEN o_orderpriority = '{lv}' THEN 1.0 ELSE 0.0 END) AS prev_o_orderpriority_{level_name(lv)}_mean"
              for lv in FT.PRIORITIES]
    items = S.spec_sql(FT.PREV_SPEC, "prev", scales=MONEY) + shares
    subs = {"approved": "o_orderstatus = 'F'", "refused": "o_orderstatus = 'P'"}
    for pre, w in subs.items():
        items += S.spec_sql(FT.PREV_SPEC, pre, w, absent_null=True, scales=MONEY)
    ratios = [f"approved_{c}_{f} / nullif(refused_{c}_{f}, 0) AS ratio_approved_refused_{c}_{f}"
              for c, fs in FT.PREV_SPEC.items() for f in fs]
    return f"WITH s AS (SELECT o_custkey, {_sel(items)} FROM {P} p GROUP BY o_custkey) SELECT *, {_sel(ratios)} FROM s"


PREV_EXACT = ["o_custkey"] + [f"{p}_day_{f}" for p in ("prev", "approved", "refused") for f in ("min", "max")]


@register("features_previous_apps", _prev_sql(), exact=PREV_EXACT)
def features_previous_apps_q(spark, d):
    return FT.features_previous_apps(spark, d)


def _history_sql() -> str:
    ks = FT.HISTORY_KS
    lastk = _sel([f"{S.agg('o_totalprice', 'mean', f'rn <= {k}', 2)} AS hist_last{k}_o_totalprice_mean, "
                  f"avg(day) FILTER (WHERE rn <= {k}) AS hist_last{k}_day_mean" for k in ks])
    return f"""WITH p AS {P},
  last AS (SELECT o_custkey, arg_max(o_totalprice, (day, o_orderkey)) FILTER (WHERE o_orderstatus = 'F') AS last_approved_amount,
    arg_max(o_totalprice, (day, o_orderkey)) FILTER (WHERE o_orderstatus = 'P') AS last_refused_amount,
    arg_max(o_totalprice, (day, o_orderkey)) FILTER (WHERE o_orderstatus = 'O') AS last_revolving_amount,
    max(day) AS last_day FROM p GROUP BY o_custkey),
  r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) AS rn FROM p),
  lk AS (SELECT o_custkey, {lastk} FROM r GROUP BY o_custkey),
  dd AS (SELECT DISTINCT o_custkey, day FROM (SELECT o_custkey, day, dense_rank() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS dr FROM p) WHERE dr = 2),
  sec AS (SELECT o_custkey, {S.agg('o_totalprice', 'mean', None, 2)} AS second_latest_amount_mean FROM p JOIN dd USING (o_custkey, day) GROUP BY o_custkey)
  SELECT last.*, lk.* EXCLUDE (o_custkey), sec.second_latest_amount_mean
  FROM last LEFT JOIN lk USING (o_custkey) LEFT JOIN sec USING (o_custkey)"""


@register("features_previous_history", _history_sql(), exact=["o_custkey", "last_day"])
def features_previous_history_q(spark, d):
    return FT.features_previous_history(spark, d)


DOWN_SQL = f"""SELECT o_custkey, {_sel([f"{f}({x} / nullif({y}, 0)) AS {n}_{m}" for n, (x, y) in FT.DOWN_RATIOS.items() for m, f in (("mean", "avg"), ("min", "min"), ("max", "max"))])},
  avg(instalment / nullif(paid_day - due_day + 1, 0)) AS dp_per_day_mean
  FROM (SELECT i.*, p.o_totalprice AS credit FROM {I} i JOIN {P} p ON p.o_orderkey = i.l_orderkey) WHERE due_day > -830 GROUP BY o_custkey"""


@register("features_previous_down_payment", DOWN_SQL, exact=["o_custkey"])
def features_previous_down_payment_q(spark, d):
    return FT.features_previous_down_payment(spark, d)


REJECTS_SQL = f"""WITH r AS (SELECT * FROM {P} p WHERE o_orderstatus = 'P'),
  c AS (SELECT o_custkey, {_sel([f"count(*) FILTER (WHERE o_orderpriority = '{lv}') AS reject_{level_name(lv)}" for lv in FT.PRIORITIES])}
        FROM r GROUP BY o_custkey),
  l AS (SELECT o_custkey, {_sel([f"max(CASE WHEN o_orderpriority = '{lv}' THEN 1 ELSE 0 END) AS last_reject_{level_name(lv)}" for lv in FT.PRIORITIES])}
        FROM r WHERE day = (SELECT max(day) FROM r r2 WHERE r2.o_custkey = r.o_custkey) GROUP BY o_custkey)
  SELECT c.*, l.* EXCLUDE (o_custkey) FROM c LEFT JOIN l USING (o_custkey)"""


@register("features_previous_rejects", REJECTS_SQL, all_exact=True)
def features_previous_rejects_q(spark, d):
    return FT.features_previous_rejects(spark, d)


# ---------------------------------------------------------------- balance families
#: slopes of flat series are 0 but for rounding: compared by decimals
POS_TRENDS = {f"pos{m}_late_{part}": 8 for m in (60, 18) for part in ("slope", "intercept")}
POS_SQL = f"""WITH e AS {E},
  b AS (SELECT user_id, min(day) AS pos_day_min, max(day) AS pos_day_max, count(*) AS pos_size,
    {S.agg('value', 'mean', None, 2)} AS pos_value_mean, max(value) AS pos_value_max,
    count(*) FILTER (WHERE value > 40) AS pos_late_total, count(*) FILTER (WHERE value > 40 AND day > -18) AS pos_late_recent,
    {_sel([f"avg(CASE WHEN event_type = '{t}' THEN 1.0 ELSE 0.0 END) AS pos_event_type_{t}_mean" for t in FT.EVENT_TYPES])}
    FROM e GROUP BY user_id),
  l AS (SELECT user_id, count(*) AS pos_last_day_events, {S.agg('value', 'sum', None, 2)} AS pos_last_day_value
    FROM e WHERE day = (SELECT max(day) FROM e e2 WHERE e2.user_id = e.user_id) GROUP BY user_id),
  dl AS (SELECT user_id, day, count(*) FILTER (WHERE value > 40) AS late FROM e GROUP BY user_id, day),
  t AS (SELECT user_id, CASE WHEN var_pop(day) FILTER (WHERE day > -60) > 0 THEN regr_slope(late::DOUBLE, day::DOUBLE) FILTER (WHERE day > -60) END AS pos60_late_slope, CASE WHEN var_pop(day) FILTER (WHERE day > -60) > 0 THEN regr_intercept(late::DOUBLE, day::DOUBLE) FILTER (WHERE day > -60) ELSE avg(late) FILTER (WHERE day > -60) END AS pos60_late_intercept, CASE WHEN var_pop(day) FILTER (WHERE day > -18) > 0 THEN regr_slope(late::DOUBLE, day::DOUBLE) FILTER (WHERE day > -18) END AS pos18_late_slope, CASE WHEN var_pop(day) FILTER (WHERE day > -18) > 0 THEN regr_intercept(late::DOUBLE, day::DOUBLE) FILTER (WHERE day > -18) ELSE avg(late) FILTER (WHERE day > -18) END AS pos18_late_intercept FROM dl GROUP BY user_id)
  SELECT b.*, l.* EXCLUDE (user_id), t.* EXCLUDE (user_id) FROM b LEFT JOIN l USING (user_id) LEFT JOIN t USING (user_id)"""
POS_LAST_SQL = f"""WITH rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {E} e)
  SELECT user_id, {_sel([f"count(*) FILTER (WHERE rn <= {k} AND value > 40) AS pos_last{k}_late_sum, {S.agg('value', 'mean', f'rn <= {k}', 2)} AS pos_last{k}_value_mean, max(value) FILTER (WHERE rn <= {k}) AS pos_last{k}_value_max, CASE WHEN count(value) FILTER (WHERE rn <= {k}) > 1 THEN regr_slope(value, {k} + 1 - rn) FILTER (WHERE rn <= {k}) END AS pos_last{k}_value_slope" for k in FT.POS_KS])} FROM rk GROUP BY user_id"""
POS_EXACT = ["user_id", "pos_day_min", "pos_day_max", "pos_size", "pos_late_total", "pos_late_recent", "pos_last_day_events"]
POS_LAST_EXACT = ["user_id", *[f"pos_last{k}_late_sum" for k in FT.POS_KS]]
POS_LAST_TRENDS = {f"pos_last{k}_value_slope": 6 for k in FT.POS_KS}


@register("features_pos_cash", POS_SQL, exact=POS_EXACT, sig=8, dec_cols=POS_TRENDS)
def features_pos_cash_q(spark, d):
    return FT.features_pos_cash(spark, d)


@register("features_pos_cash_last_k", POS_LAST_SQL, exact=POS_LAST_EXACT, sig=8, dec_cols=POS_LAST_TRENDS)
def features_pos_cash_last_k_q(spark, d):
    return FT.features_pos_cash_last_k(spark, d)


INS_SQL = f"""WITH x AS (SELECT o_custkey, l_orderkey, l_linenumber, due_day, paid_day - due_day AS delay, payment / nullif(instalment, 0) AS paid_share,
    instalment - payment AS paid_diff, greatest(paid_day - due_day - 60, 0) AS dpd, greatest(60 - (paid_day - due_day), 0) AS dbd
    FROM {I} i),
  a AS (SELECT o_custkey, {_sel(S.spec_sql(FT.INS_SPEC, 'ins', int_sums=['dpd', 'dbd']))}, count(*) AS ins_count,
    count(DISTINCT l_linenumber) AS ins_version_nunique FROM x GROUP BY o_custkey),
  r AS (SELECT o_custkey, avg(CAST(coalesce(dpd > 0, false) AS INTEGER)) FILTER (WHERE due_day > -366) AS ins_recent_late_share FROM x GROUP BY o_custkey),
  lo AS (SELECT o_custkey, arg_max(l_orderkey, (due_day, l_orderkey)) AS l_orderkey FROM x GROUP BY o_custkey),
  l AS (SELECT o_custkey, avg(paid_share) AS ins_last_order_paid_share FROM x JOIN lo USING (o_custkey, l_orderkey) GROUP BY o_custkey),
  t AS (SELECT o_custkey, CASE WHEN var_pop(due_day) FILTER (WHERE true) > 0 THEN regr_slope(dpd::DOUBLE, due_day::DOUBLE) FILTER (WHERE true) END AS ins_dpd_slope, CASE WHEN var_pop(due_day) FILTER (WHERE true) > 0 THEN regr_intercept(dpd::DOUBLE, due_day::DOUBLE) FILTER (WHERE true) ELSE avg(dpd) FILTER (WHERE true) END AS ins_dpd_intercept, CASE WHEN var_pop(due_day) FILTER (WHERE due_day > -366) > 0 THEN regr_slope(delay::DOUBLE, due_day::DOUBLE) FILTER (WHERE due_day > -366) END AS ins_recent_delay_slope, CASE WHEN var_pop(due_day) FILTER (WHERE due_day > -366) > 0 THEN regr_intercept(delay::DOUBLE, due_day::DOUBLE) FILTER (WHERE due_day > -366) ELSE avg(delay) FILTER (WHERE due_day > -366) END AS ins_recent_delay_intercept
        FROM x GROUP BY o_custkey)
  SELECT a.*, r.ins_recent_late_share, l.ins_last_order_paid_share, t.* EXCLUDE (o_custkey)
  FROM a LEFT JOIN r USING (o_custkey) LEFT JOIN l USING (o_custkey) LEFT JOIN t USING (o_custkey)"""
INS_EXACT = ["o_custkey", "ins_dpd_max", "ins_dbd_max", "ins_dpd_sum", "ins_dbd_sum", "ins_count", "ins_version_nunique"]


@register("features_installments", INS_SQL, exact=INS_EXACT, sig=8)
def features_installments_q(spark, d):
    return FT.features_installments(spark, d)


CC_SQL = f"""WITH e AS {E},
  c AS (SELECT user_id, {_sel(S.spec_sql({'value': ['min', 'max', 'mean', 'sum', 'var'], 'day': ['min', 'max', 'mean', 'sum', 'var']}, 'cc', int_sums=['day']))},
    avg(value) / nullif(max(value), 0) AS cc_limit_loading,
    {S.agg('value', 'sum', "event_type = 'purchase'", 2)} / nullif({S.agg('value', 'sum', None, 2)}, 0) AS cc_purchase_ratio,
    max(CASE WHEN event_type = 'purchase' THEN value END) / nullif(max(value), 0) AS cc_max_purchase_ratio,
    avg(CASE WHEN value > 40 THEN 1 ELSE 0 END) AS cc_over_share
    FROM e GROUP BY user_id),
  x AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dv FROM e),
  ch AS (SELECT user_id, avg(dv) AS cc_balance_change_mean FROM x GROUP BY user_id),
  ln AS (SELECT user_id, event_type, {S.agg('value', 'sum', None, 2)} AS v, max(value) AS top, count(*) AS n FROM e GROUP BY ALL),
  bl AS (SELECT user_id, count(*) AS cc_loans, max(v) AS cc_loan_sum_max, min(v) AS cc_loan_sum_min, avg(top) AS cc_loan_max_mean, max(n) AS cc_loan_n_max,
    max(CASE WHEN event_type = 'purchase' THEN v END) - sum(v) AS cc_receivable_diff FROM ln GROUP BY user_id)
  SELECT c.*, ch.cc_balance_change_mean, bl.* EXCLUDE (user_id) FROM c JOIN ch USING (user_id) JOIN bl USING (user_id)"""
CC_EXACT = ["user_id", "cc_day_min", "cc_day_max", "cc_day_sum", "cc_loans", "cc_loan_n_max"]


@register("features_credit_card", CC_SQL, exact=CC_EXACT,
          dec_cols={"cc_balance_change_mean": 8})
def features_credit_card_q(spark, d):
    return FT.features_credit_card(spark, d)


LABEL_SQL = f"""SELECT user_id, count(DISTINCT event_type) AS nuniq_event_type, count(DISTINCT day) AS nuniq_day,
  {S.agg('value', 'mean', None, 2)} AS mean_value, avg(day) AS mean_day, avg(event_id) AS mean_event_id FROM {E} e GROUP BY user_id"""


@register("features_label_nunique_mean", LABEL_SQL, exact=["user_id", "nuniq_event_type", "nuniq_day"])
def features_label_nunique_mean_q(spark, d):
    return FT.features_label_nunique_mean(spark, d)


# ---------------------------------------------------------------- assembly, OOF matrix, stacker
def _assemble_sql() -> str:
    parts = [("r", "c_custkey", RATIOS_SQL, ()), ("nw", "c_custkey", NEW_SQL, ("income", "ext1", "ext2", "ext3")),
             ("pr", "c_custkey", PRODUCTS_SQL, ()), ("ct", "c_custkey", CONTEST_SQL, ()), ("bu", "o_custkey", _bureau_sql(), ()),
             ("su", "o_custkey", SUMMARY_SQL, ()), ("st", "o_custkey", STATUS_SQL, ()), ("pa", "o_custkey", _prev_sql(), ()),
             ("hi", "o_custkey", _history_sql(), ("last_day",)), ("dp", "o_custkey", DOWN_SQL, ()), ("rj", "o_custkey", REJECTS_SQL, ()),
             ("ps", "user_id", POS_SQL, ()), ("pl", "user_id", POS_LAST_SQL, ()), ("ins", "o_custkey", INS_SQL, ()), ("cc", "user_id", CC_SQL, ()), ("lb", "user_id", LABEL_SQL, ())]
    tables = ", ".join(f"{n} AS ({sql})" for n, _, sql, _ in parts)
    columns = ", ".join(f"{n}.* EXCLUDE ({', '.join((key, *known))})" for n, key, _, known in parts)
    joins = " ".join(f"LEFT JOIN {n} ON b.c_custkey = {n}.{key}" for n, key, _, _ in parts)
    return f"WITH {tables} SELECT b.* EXCLUDE (c_mktsegment), {columns} FROM {APP_BASE_SQL} b {joins}"


ASSEMBLE_EXACT = [
    "c_custkey", "is_train", "n_regionkey", "days_birth", "days_employed", "children", *RATIOS_EXACT[1:],
    "new_flag_sum", "new_income_bin", "new_ext3_cluster", "capped_children3", "flag_sum", "n_missing", "recent_job_days",
    *_bureau_exact()[1:], *SUMMARY_EXACT[1:], "span_days_max", "closing_day_min", *PREV_EXACT[1:],
    *[f"{p}_{level_name(lv)}" for p in ("reject", "last_reject") for lv in FT.PRIORITIES],
    *POS_EXACT[1:], *POS_LAST_EXACT[1:], *INS_EXACT[1:],
    *CC_EXACT[1:], "nuniq_event_type", "nuniq_day"]


@register("assemble_training_table", _assemble_sql(), exact=ASSEMBLE_EXACT, sig=8,
          dec_cols={"new_row_kurt": 6, "cc_balance_change_mean": 8, **POS_TRENDS, **POS_LAST_TRENDS})
def assemble_training_table_q(spark, d):
    return _clustered(FT.assemble_training_table(spark, d))


@register("load_oof_matrix", f"""WITH {_PRED_SQL}
  SELECT p0.doc_id, p0.fold, m0, m1, m2, l.quality FROM p0 JOIN p1 ON p0.doc_id = p1.doc_id AND p0.fold = p1.fold
  JOIN p2 ON p0.doc_id = p2.doc_id AND p0.fold = p2.fold JOIN labels l ON p0.doc_id = l.doc_id""",
          exact=["doc_id", "fold", "quality"])
def load_oof_matrix_q(spark, d):
    """Prediction store (long) → one column per model, only complete rows, with labels."""
    path = sinks.scratch_path(spark, "oof-store")
    sinks.write_table(_long_predictions(spark, d), path, partition_by=["model"])
    long = spark.read.parquet(path)
    wide = wide_predictions(long, "doc_id", "fold", ["m0", "m1", "m2"])
    return wide.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "inner")


_STACK_KEYS = f"""SELECT p0.doc_id, p0.fold, l.quality FROM p0 JOIN p1 ON p0.doc_id = p1.doc_id AND p0.fold = p1.fold
  JOIN p2 ON p0.doc_id = p2.doc_id AND p0.fold = p2.fold LEFT JOIN labels l ON p0.doc_id = l.doc_id"""


@register("stack_train", f"""WITH {_PRED_SQL}, k AS ({_STACK_KEYS})
  SELECT doc_id, CASE WHEN quality IS NULL THEN 'test' ELSE 'oof' END AS part, true AS in_range FROM k""", all_exact=True)
def stack_train_q(spark, d):
    """OOF matrix → elimination → folds × five bags (logistic, C by bag) → ranks
    averaged over the bags of a fold, for the test rows over the folds too →
    clipped scores: one OOF row per labelled and one submission row per test key."""
    wide = wide_predictions(_long_predictions(spark, d), "doc_id", "fold", ["m0", "m1", "m2"])
    m = wide.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    train, test = m.where("quality IS NOT NULL"), m.where("quality IS NULL")
    kept = selection.recursive_elimination(train, ["m0", "m1", "m2"], "quality", keep=2, step=1)
    bags = [1, 2, 3, 4, 5]
    o, t = oof.bagged_oof(train, test, "doc_id", "quality", kept, "fold",
                          lambda b, size: oof.fit_logistic(c=0.1 * b, total_weight=size.weight), bags=bags)
    names = [f"b{b}" for b in bags]

    def ranked(long):
        by_bag = long.groupBy("doc_id", "fold").pivot("bag", bags).agg(F.max("score")).toDF("doc_id", "fold", *names)
        by_bag = by_bag.withColumn("__row", F.concat_ws("/", "doc_id", "fold"))
        return B.rank_average(by_bag, names, "score", "min", by=["fold"], key="__row").select("doc_id", "score")
    both = ranked(o).withColumn("part", F.lit("oof")).unionByName(B.mean_blend(ranked(t), "doc_id", "score").withColumn("part", F.lit("test")))
    clipped = F.least(F.greatest("score", F.lit(0.001)), F.lit(0.999))
    return both.select("doc_id", "part", clipped.between(0.0, 1.0).alias("in_range"))
