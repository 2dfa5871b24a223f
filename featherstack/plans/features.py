"""Composite per-entity feature plans (the reference's feature families) on
the stand-in tables of ``fixture``.

Each family is one lazy plan: aggregates keyed by the entity, pre-aggregated
below the entity where a child table is involved, then joined once by key.
``assemble_training_table`` puts them side by side; at scale the wide table
is the place to cut lineage (``materialize``) before model fitting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, rowstats, scalar
from ..operators import agg as A
from ..operators import bins as Bn
from ..operators import groupstats as G
from ..operators import ordered as O
from ..operators.rank import global_quantiles
from ..operators.select import aggregate
from ..sources.store import FeatureStore
from . import fixture as fx

MONEY = {"o_totalprice": 2, "c_acctbal": 2}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# ---------------------------------------------------------------- application families
def application_base(spark: SparkSession, d: str) -> DataFrame:
    """Application-like numeric columns on the entity table.

    income = account balance; three "external scores" in [0, 1] with
    planted missing values; an age-like and an employment-like day count
    with the 365243 sentinel on some rows.
    """
    a = fx.application(spark, d)
    return a.select(
        "c_custkey", "is_train", "c_mktsegment", "n_regionkey",
        F.col("c_acctbal").alias("income"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey") / 24.0).alias("ext1"),
        (F.col("n_regionkey") / 4.0).alias("ext2"),
        F.when(F.col("c_custkey") % 7 != 0, (F.col("c_custkey") % 100) / 100.0).alias("ext3"),
        (-(F.col("c_custkey") % 20000) - 7000).alias("days_birth"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(365243)).otherwise(-(F.col("c_custkey") % 3000)).alias("days_employed"),
        (F.col("c_nationkey") % 4).alias("children"),
    )


def features_application_ratios(spark: SparkSession, d: str) -> DataFrame:
    a = clean.sentinel_to_null(application_base(spark, d), {"days_employed": 365243})
    ext = ["ext1", "ext2", "ext3"]
    return a.select(
        "c_custkey",
        scalar.safe_div("income", F.col("children") + 1).alias("income_per_child"),
        scalar.safe_div("days_employed", "days_birth").alias("employed_to_birth"),
        scalar.safe_div("income", "days_birth").alias("income_per_day_age"),
        *rowstats.row_stats(ext, ["min", "max", "sum", "mean", "median", "std"], "ext"),
        clean.compare_flag(F.col("days_birth") / -365.25 < 30).alias("young_flag"),
        clean.missing_flag("days_employed").alias("employed_missing"),
        scalar.safe_div("income", F.col("children") + 2).alias("income_per_person"),
        scalar.safe_div("children", F.col("children") + 2).alias("child_share"),
        (F.col("children") + 2).alias("family_size"),
        scalar.safe_div("income", "days_employed").alias("income_per_day_employed"),
        (F.col("days_employed") - F.col("days_birth")).alias("days_before_work"),
        scalar.safe_div(F.col("days_employed") - F.col("days_birth"), "days_birth").alias("before_work_to_birth"),
        (F.col("days_birth") / -365.25).alias("age_years"), (F.col("days_employed") / -365.25).alias("work_years"),
        (F.col("ext1") * 2 + F.col("ext2") * 3 + F.col("ext3") * 4).alias("ext_weighted"),
        (F.col("ext1") * F.col("ext2") * F.col("ext3")).alias("ext_prod"),
        scalar.safe_div("ext1", F.col("ext2") + F.col("ext3")).alias("ext1_to_rest"),
        rowstats.row_stat("missing", ext, "ext_missing"),
        clean.compare_flag(F.col("days_birth") < -14000).alias("retirement_age_flag"),
        clean.compare_flag(F.col("days_employed") < -2000).alias("long_employment_flag"),
        clean.compare_flag((F.col("children") > 2) & (F.col("income") < 1000)).alias("large_poor_family_flag"),
        clean.compare_flag(F.col("income") < 0).alias("negative_income_flag"),
        F.when(F.col("income") > 0, F.log1p("income")).alias("log_income"),
    )


def features_application_new(spark: SparkSession, d: str, clusters: bool = True) -> DataFrame:
    """Ratios, flag row statistics, centred income, group recipes, bins and
    (optionally) the id of the best four clusters of a score."""
    a = clean.sentinel_to_null(application_base(spark, d), {"days_employed": 365243})
    flags = [clean.compare_flag(F.col(c).isNull()) for c in ("ext1", "ext3", "days_employed")]
    mean_income = F.lit(a.agg(F.avg("income")).first()[0])
    edges = Bn.fit_edges(a, ["income"], 16)["income"]  # its middle edge is the median, unless edges fall together
    med_income = global_quantiles(a, ["income"], [0.5])["income"][0] if len(edges) < 17 else edges[8]
    base = a.select("c_custkey", "c_mktsegment", "n_regionkey", "income", "ext1", "ext2", "ext3",
                    scalar.safe_div(F.col("ext1") + F.col("ext2"), F.col("ext3") + 1).alias("new_ext_ratio"),
                    rowstats.row_flag_sum(flags).alias("new_flag_sum"),
                    rowstats.row_stat("kurt", ["ext1", "ext2", "ext3", "income"], "new_row_kurt"),
                    (F.col("income") - mean_income).alias("new_income_centred_mean"),
                    (F.col("income") - F.lit(med_income)).alias("new_income_centred_median"))
    out = G.group_recipes(base, [(["c_mktsegment", "n_regionkey"], [("income", "median"), ("ext2", "mean")])])
    out = out.withColumn("new_income_bin", Bn.quantile_bin("income", edges))
    if clusters:
        out = Bn.kmeans_1d(out, "ext3", 4, "new_ext3_cluster", fill=0.5, log1p=False, fit_on=a)
    return out.drop("c_mktsegment", "n_regionkey")


SCORES = ["ext1", "ext2", "ext3"]
PAIRS = [("ext1", "ext2"), ("ext1", "ext3"), ("ext2", "ext3")]


def features_application_products(spark: SparkSession, d: str) -> DataFrame:
    """Products and quotients of the three scores, and of each with income and age."""
    a = clean.sentinel_to_null(application_base(spark, d), {"days_employed": 365243})
    return a.select("c_custkey",
                    *[(F.col(x) * F.col(y)).alias(f"{x}_x_{y}") for x, y in PAIRS],
                    (F.col("ext1") * F.col("ext2") * F.col("ext3")).alias("ext_product"),
                    *[scalar.safe_div(x, y).alias(f"{x}_over_{y}") for x, y in PAIRS],
                    *[scalar.safe_div("income", x).alias(f"income_over_{x}") for x in SCORES],
                    *[(F.col("income") * F.col(x)).alias(f"income_x_{x}") for x in SCORES],
                    *[scalar.safe_div(x, "days_birth").alias(f"{x}_over_age") for x in SCORES],
                    scalar.safe_div("days_employed", "ext2").alias("employed_over_ext2"))


def features_application_contest_r(spark: SparkSession, d: str) -> DataFrame:
    """Log/sqrt ratios, capped counts, flag sums and missing-aware counters."""
    a = clean.sentinel_to_null(application_base(spark, d), {"days_employed": 365243})
    a = clean.outlier_to_null(a, {"income": F.col("income") > 9000})
    return a.select(
        "c_custkey",
        scalar.safe_log1p(scalar.safe_div("income", F.col("children") + 1)).alias("log_income_per_child"),
        scalar.safe_sqrt(F.abs("days_birth")).alias("sqrt_age_days"),
        clean.cap_value(F.col("children") * 3, 6).alias("capped_children3"),
        rowstats.row_flag_sum([clean.compare_flag(F.col("ext1") > 0.5), clean.compare_flag(F.col("ext3") > 0.5),
                               clean.membership_flag("c_mktsegment", ["BUILDING", "MACHINERY"])]).alias("flag_sum"),
        (F.coalesce(F.col("ext1"), F.lit(0.0)) + F.coalesce(F.col("ext3"), F.lit(0.0))).alias("ext13_counter"),
        rowstats.row_stat("missing", ["ext1", "ext3", "income", "days_employed"], "n_missing"),
        scalar.positive_part(F.col("days_employed") + 1000, keep_null=True).alias("recent_job_days"),
    )


# ---------------------------------------------------------------- child-table families
BB_SPEC = {"ship_day": ["min", "max", "size", "median"]}
BUREAU_NUM = {"day": ["min", "max", "median", "var"], "o_totalprice": ["max", "median", "sum"],
              "bb_ship_day_min": ["min", "median"], "bb_ship_day_max": ["max", "median"],
              "bb_ship_day_size": ["median", "sum"]}


def features_bureau_two_level(spark: SparkSession, d: str) -> DataFrame:
    """lines → order (bureau balance → bureau) → customer, with active
    (status O) and closed (status F) subsets and their ratios."""
    li = fx.lines(spark, d)
    shares = A.share_of_levels(li, "l_orderkey", "l_returnflag", ["A", "N", "R"], "bb", null_level=False, fn="median")
    bb = aggregate(li, "l_orderkey", [*A.agg_exprs(BB_SPEC, "bb"), *shares], A.picks(BB_SPEC, "bb"))
    orders = fx.previous(spark, d)
    bureau = orders.join(bb.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    cat = {"bb_l_returnflag_a_median": ["median"], "bb_l_returnflag_r_median": ["median"]}
    sub_aggs, sub_outs, sub_picks = A.subset_parts(BUREAU_NUM, {"active": "o_orderstatus = 'O'", "closed": "o_orderstatus = 'F'"},
                                        ratios=[("active", "closed")], ratio_prefix="new_ratio", scales=MONEY)
    all_spec = {**BUREAU_NUM, **cat}
    all_names = [A.feature_name("buro", c, fn) for c, fn in A._pairs(all_spec)]
    # one aggregate pass: all rows, the active subset and the closed subset
    return aggregate(bureau, "o_custkey", [*A.agg_exprs(all_spec, "buro", scales=MONEY), *sub_aggs],
                     [*A.picks(all_spec, "buro"), *sub_picks], rows=orders).select("o_custkey", *all_names, *sub_outs)


def features_bureau_summary(spark: SparkSession, d: str) -> DataFrame:
    p = fx.previous(spark, d)
    return p.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("bureau_count"),
        F.count_distinct("o_orderpriority").alias("bureau_types"),
        F.try_divide(F.count(F.lit(1)), F.count_distinct("o_orderpriority")).alias("loans_per_type"),
        F.avg(clean.compare_flag(F.col("o_orderstatus") == "O")).alias("active_share"),
        A.agg_expr("o_totalprice", "sum", "o_orderstatus = 'O'", 2).alias("active_amount_sum"),
        F.try_divide(A.agg_expr("o_totalprice", "sum", "o_orderstatus = 'O'", 2),
                     A.agg_expr("o_totalprice", "sum", None, 2)).alias("active_amount_share"),
        F.max("day").alias("last_day"),
        F.try_divide(A.agg_expr("o_totalprice", "sum", "o_orderstatus = 'P'", 2),
                     A.agg_expr("o_totalprice", "sum", "o_orderstatus = 'O'", 2)).alias("overdue_to_debt"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("prolonged_sum"),
        F.avg(clean.compare_flag(F.col("day") > -365)).alias("recent_share"),
    )


def features_bureau_status(spark: SparkSession, d: str) -> DataFrame:
    """First/last line status per order, covered span and closing day, then per customer."""
    li = fx.lines(spark, d)
    per_order = li.groupBy("l_orderkey").agg(
        F.min_by("l_linestatus", F.struct("ship_day", "l_linenumber", "l_partkey")).alias("status_first"),
        F.max_by("l_linestatus", F.struct("ship_day", "l_linenumber", "l_partkey")).alias("status_last"),
        (F.max("ship_day") - F.min("ship_day")).alias("span_days"),
        F.min(F.when(F.col("l_linestatus") == "F", F.col("ship_day"))).alias("closing_day"))
    orders = fx.previous(spark, d).select("o_orderkey", "o_custkey")
    j = orders.join(per_order.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "inner")
    return j.groupBy("o_custkey").agg(
        F.avg(clean.compare_flag(F.col("status_first") == "F")).alias("first_closed_share"),
        F.avg(clean.compare_flag(F.col("status_last") == "F")).alias("last_closed_share"),
        F.avg("span_days").alias("span_days_mean"), F.max("span_days").alias("span_days_max"),
        F.min("closing_day").alias("closing_day_min"))


PREV_SPEC = {"o_totalprice": ["min", "max", "mean", "sum"], "day": ["min", "max", "mean"]}


def features_previous_apps(spark: SparkSession, d: str) -> DataFrame:
    p = fx.previous(spark, d)
    shares = A.share_of_levels(p, "o_custkey", "o_orderpriority", PRIORITIES, "prev", null_level=False)
    sub_aggs, sub_outs, _ = A.subset_parts(PREV_SPEC, {"approved": "o_orderstatus = 'F'", "refused": "o_orderstatus = 'P'"},
                                        ratios=[("approved", "refused")], scales=MONEY)
    names = [A.feature_name("prev", c, fn) for c, fn in A._pairs(PREV_SPEC)]
    names += [f"prev_o_orderpriority_{A.level_name(lv)}_mean" for lv in PRIORITIES]
    return p.groupBy("o_custkey").agg(*A.agg_exprs(PREV_SPEC, "prev", scales=MONEY), *shares, *sub_aggs) \
        .select("o_custkey", *names, *sub_outs)


HISTORY_KS = [1, 2, 3, 8, 16, 32]


def features_previous_history(spark: SparkSession, d: str) -> DataFrame:
    """Last approved, refused and revolving (open) amount, last-k means, second-latest day aggregate."""
    p = fx.previous(spark, d)
    last = p.groupBy("o_custkey").agg(
        F.max_by(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")),
                 F.when(F.col("o_orderstatus") == "F", F.struct("day", "o_orderkey"))).alias("last_approved_amount"),
        F.max_by(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")),
                 F.when(F.col("o_orderstatus") == "P", F.struct("day", "o_orderkey"))).alias("last_refused_amount"),
        F.max_by(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")),
                 F.when(F.col("o_orderstatus") == "O", F.struct("day", "o_orderkey"))).alias("last_revolving_amount"),
        F.max_by(F.col("day"), F.struct("day", "o_orderkey")).alias("last_day"))
    lastk = O.last_k_agg(p, "o_custkey", [F.col("day").desc(), F.col("o_orderkey").desc()],
                         {"o_totalprice": ["mean"], "day": ["mean"]}, HISTORY_KS, "hist", salt_cols=["o_orderkey"],
                         scales=MONEY)
    second = O.nth_latest_rows(p, "o_custkey", "day", 2).groupBy("o_custkey").agg(
        A.agg_expr("o_totalprice", "mean", None, 2).alias("second_latest_amount_mean"))
    return last.join(lastk, "o_custkey", "left").join(second, "o_custkey", "left")


DOWN_RATIOS = {"dp_ratio": ("payment", "instalment"), "dp_credit": ("payment", "credit"), "dp_annuity": ("instalment", "credit")}


def features_previous_down_payment(spark: SparkSession, d: str) -> DataFrame:
    """Payment to instalment, payment to credit and instalment to credit of the last 830 days."""
    credit = fx.previous(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("credit"))
    i = fx.installments(spark, d).where(F.col("due_day") > -830).join(credit, "l_orderkey")
    stats = [fn(scalar.safe_div(x, y)).alias(f"{n}_{f}") for n, (x, y) in DOWN_RATIOS.items() for f, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return i.groupBy("o_custkey").agg(*stats, F.avg(scalar.safe_div("instalment", F.col("paid_day") - F.col("due_day") + 1)).alias("dp_per_day_mean"))


def features_previous_rejects(spark: SparkSession, d: str) -> DataFrame:
    r = fx.previous(spark, d).where(F.col("o_orderstatus") == "P")
    names = [A.level_name(lv) for lv in PRIORITIES]
    days = r.groupBy("o_custkey", "day").agg(*[F.count_if(F.col("o_orderpriority") == lv).alias(n) for lv, n in zip(PRIORITIES, names)])
    return days.groupBy("o_custkey").agg(
        *[F.sum(n).alias(f"reject_{n}") for n in names],
        *[clean.compare_flag(F.max_by(n, "day") > 0).alias(f"last_reject_{n}") for n in names])


POS_KS = [6, 12, 30]


def features_pos_cash(spark: SparkSession, d: str) -> DataFrame:
    """Monthly-balance family on events: day aggregates, late (value > 40)
    totals in the last 18 days and overall, status shares, last-entity rows."""
    e = fx.events(spark, d)
    late = F.col("value") > 40
    types = [f"n_{t}" for t in EVENT_TYPES]
    days = e.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("nv"), A.agg_expr("value", "sum", None, 2).alias("total"),
        F.max("value").alias("top"), F.count_if(late).alias("late"),
        *[F.count_if(F.col("event_type") == t).alias(n) for t, n in zip(EVENT_TYPES, types)])
    shares = [(F.sum(n) / F.sum("n")).alias(f"pos_event_type_{t}_mean") for t, n in zip(EVENT_TYPES, types)]
    return days.groupBy("user_id").agg(
        F.min("day").alias("pos_day_min"), F.max("day").alias("pos_day_max"), F.sum("n").alias("pos_size"),
        F.try_divide(F.sum("total"), F.sum("nv")).alias("pos_value_mean"), F.max("top").alias("pos_value_max"),
        F.sum("late").alias("pos_late_total"),
        F.coalesce(F.sum(F.when(F.col("day") > -18, F.col("late"))), F.lit(0)).alias("pos_late_recent"), *shares,
        F.max_by("n", "day").alias("pos_last_day_events"), F.max_by("total", "day").alias("pos_last_day_value"),
        *O.trend_exprs("late", "day", "pos60", where=F.col("day") > -60),
        *O.trend_exprs("late", "day", "pos18", where=F.col("day") > -18))


def features_pos_cash_last_k(spark: SparkSession, d: str) -> DataFrame:
    """The balance family's second part: aggregates and trends of the last k
    events, from one ranking for all k."""
    e = fx.events(spark, d).withColumn("late", clean.compare_flag(F.col("value") > 40))
    ranked = O.top_k_per_group(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], max(POS_KS), ["event_id"])
    last = []
    for k in POS_KS:
        within = f"rn <= {k}"
        last += [A.agg_expr("late", "sum", within).alias(f"pos_last{k}_late_sum"), A.agg_expr("value", "mean", within, 2).alias(f"pos_last{k}_value_mean"),
                 A.agg_expr("value", "max", within).alias(f"pos_last{k}_value_max"),
                 F.regr_slope(F.when(F.expr(within), F.col("value")), F.when(F.expr(within), k + 1.0 - F.col("rn"))).alias(f"pos_last{k}_value_slope")]
    return ranked.groupBy("user_id").agg(*last)


INS_SPEC = {"paid_share": ["mean", "min", "max", "median", "var"], "paid_diff": ["mean", "sum", "max", "median", "var"],
            "dpd": ["mean", "max", "median", "sum", "var"], "dbd": ["mean", "max", "median", "sum", "var"]}


def features_installments(spark: SparkSession, d: str) -> DataFrame:
    i = fx.installments(spark, d)
    delay = F.col("paid_day") - F.col("due_day")
    x = i.select("o_custkey", "l_orderkey", "l_linenumber", "due_day", delay.alias("delay"),
                 scalar.safe_div("payment", "instalment").alias("paid_share"),
                 (F.col("instalment") - F.col("payment")).alias("paid_diff"),
                 scalar.positive_part(delay - 60).alias("dpd"), scalar.positive_part(60 - delay).alias("dbd"))
    recent = F.col("due_day") > -366
    by_customer = aggregate(x, "o_custkey", [
        *A.agg_exprs(INS_SPEC, "ins"), F.count(F.lit(1)).alias("ins_count"),
        A.agg_expr("l_linenumber", "nunique_small").alias("ins_version_nunique"),
        F.avg(F.when(recent, clean.compare_flag(F.col("dpd") > 0))).alias("ins_recent_late_share"),
        *O.trend_exprs("dpd", "due_day", "ins", fill_y=0.0),
        *O.trend_exprs("delay", "due_day", "ins_recent", where=recent)], A.picks(INS_SPEC, "ins"))
    # the last order of a customer, from one row per (customer, order)
    orders = x.groupBy("o_custkey", "l_orderkey").agg(F.max("due_day").alias("due"), F.avg("paid_share").alias("share"))
    last = orders.groupBy("o_custkey").agg(F.max_by("share", F.struct("due", "l_orderkey")).alias("ins_last_order_paid_share"))
    return by_customer.join(last, "o_custkey", "left")


def features_credit_card(spark: SparkSession, d: str) -> DataFrame:
    """Card-balance family on events: all-column aggregates, limit loading
    (value / user max), ratio of 'purchase' value, balance change."""
    e = fx.events(spark, d)
    spec = {c: ["min", "max", "mean", "sum", "var"] for c in ("value", "day")}
    cols = e.groupBy("user_id").agg(
        *A.agg_exprs(spec, "cc"),
        F.try_divide(F.avg("value"), F.max("value")).alias("cc_limit_loading"),
        F.try_divide(A.agg_expr("value", "sum", F.col("event_type") == "purchase", 2),
                     A.agg_expr("value", "sum", None, 2)).alias("cc_purchase_ratio"),
        F.try_divide(F.max(F.when(F.col("event_type") == "purchase", F.col("value"))), F.max("value")).alias("cc_max_purchase_ratio"),
        F.avg(clean.compare_flag(F.col("value") > 40)).alias("cc_over_share"))
    e2 = e.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    change = O.lagged_diff_mean(e2, "user_id", "t", "event_id", "value", {"null": "cc_balance_change_mean"})
    # per loan (here the event type), then per user; what a purchase differs from the user's mean
    loans = e.groupBy("user_id", "event_type").agg(A.agg_expr("value", "sum", None, 2).alias("v"), F.max("value").alias("top"), F.count(F.lit(1)).alias("n"))
    by_loan = loans.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("cc_loans"), F.max("v").alias("cc_loan_sum_max"), F.min("v").alias("cc_loan_sum_min"), F.avg("top").alias("cc_loan_max_mean"),
        F.max("n").alias("cc_loan_n_max"),
        (F.max(F.when(F.col("event_type") == "purchase", F.col("v"))) - F.sum("v")).alias("cc_receivable_diff"))
    return cols.join(change, "user_id").join(by_loan, "user_id")


def features_label_nunique_mean(spark: SparkSession, d: str) -> DataFrame:
    e = fx.events(spark, d)
    return e.groupBy("user_id").agg(F.count_distinct("event_type").alias("nuniq_event_type"),
                                    F.count_distinct("day").alias("nuniq_day"),
                                    A.agg_expr("value", "mean", None, 2).alias("mean_value"),
                                    F.avg("day").alias("mean_day"), F.avg("event_id").alias("mean_event_id"))


APPLICATION_FAMILIES = {"ratios": features_application_ratios, "new": features_application_new,
                        "products": features_application_products, "contest": features_application_contest_r}
CHILD_FAMILIES = {"bureau": features_bureau_two_level, "summary": features_bureau_summary, "status": features_bureau_status,
                  "apps": features_previous_apps, "history": features_previous_history, "down": features_previous_down_payment,
                  "rejects": features_previous_rejects, "pos": features_pos_cash, "pos_last": features_pos_cash_last_k, "ins": features_installments,
                  "cc": features_credit_card, "label": features_label_nunique_mean}


def _family(fn: Callable[[SparkSession, str], DataFrame], spark: SparkSession, d: str) -> DataFrame:
    """A family keyed by ``c_custkey``."""
    f = fn(spark, d)
    key = next(c for c in ("c_custkey", "o_custkey", "user_id") if c in f.columns)
    return f.where(F.col(key).isNotNull()).withColumnRenamed(key, "c_custkey")


def assemble_training_table(spark: SparkSession, d: str, store: FeatureStore | None = None) -> DataFrame:
    """Train and test entities with every entity-keyed family joined on, ids
    of child tables dropped; a column that an earlier part has already is left
    out.  The families are written to a store bucketed by the entity, several at
    a time, and so joined 1:1 without a shuffle; a store that is given keeps them
    under its own name."""
    store = store or FeatureStore(spark, "c_custkey")
    families = {**APPLICATION_FAMILIES, **CHILD_FAMILIES}
    store.write_all({"base": lambda: application_base(spark, d)} | {n: (lambda fn=fn: _family(fn, spark, d)) for n, fn in families.items()})
    return store.join("base", list(families)).drop("c_mktsegment")
