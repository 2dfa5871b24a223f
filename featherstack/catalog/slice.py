"""The flagship query (also ``entry``)."""

from __future__ import annotations

from ..plans import fixture as fx
from ..plans.slice import history_features
from .common import register

FLAGSHIP_SQL = f"""
WITH p AS {fx.PREVIOUS_SQL},
base AS (
  SELECT o_custkey,
    count(*) AS hist_size,
    coalesce(sum(CAST(round(o_totalprice * 100.0) AS BIGINT))::DOUBLE / 100.0, 0) AS hist_o_totalprice_sum, (sum(CAST(round(o_totalprice * 100.0) AS BIGINT))::DOUBLE / 100.0) / count(o_totalprice) AS hist_o_totalprice_mean,
    max(o_totalprice) AS hist_o_totalprice_max, median(o_totalprice) AS hist_o_totalprice_median,
    avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS hist_refused_share,
    CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN coalesce((sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) FILTER (WHERE o_orderstatus = 'F'))::DOUBLE / 100.0, 0) END AS appr_o_totalprice_sum,
    CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN ((sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) FILTER (WHERE o_orderstatus = 'F'))::DOUBLE / 100.0) / count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') END AS appr_o_totalprice_mean,
    max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS appr_o_totalprice_max,
    median(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS appr_o_totalprice_median,
    CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN coalesce((sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) FILTER (WHERE o_orderstatus = 'P'))::DOUBLE / 100.0, 0) END AS refu_o_totalprice_sum,
    ((sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) FILTER (WHERE o_orderstatus = 'P'))::DOUBLE / 100.0) / nullif(count(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 0) AS refu_o_totalprice_mean,
    max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS refu_o_totalprice_max,
    median(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS refu_o_totalprice_median,
    CASE WHEN var_pop(day) > 0 THEN regr_slope(o_totalprice, day) END AS hist_o_totalprice_slope
  FROM p GROUP BY o_custkey),
ranked AS (
  SELECT o_custkey, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) AS rn FROM p),
last3 AS (SELECT o_custkey, (sum(CAST(round(o_totalprice * 100.0) AS BIGINT))::DOUBLE / 100.0) / count(o_totalprice) AS hist_last3_o_totalprice_mean FROM ranked WHERE rn <= 3 GROUP BY o_custkey),
feats AS (
  SELECT b.*, l.hist_last3_o_totalprice_mean,
    appr_o_totalprice_sum / nullif(refu_o_totalprice_sum, 0) AS ratio_appr_refu_o_totalprice_sum,
    appr_o_totalprice_mean / nullif(refu_o_totalprice_mean, 0) AS ratio_appr_refu_o_totalprice_mean,
    appr_o_totalprice_max / nullif(refu_o_totalprice_max, 0) AS ratio_appr_refu_o_totalprice_max,
    appr_o_totalprice_median / nullif(refu_o_totalprice_median, 0) AS ratio_appr_refu_o_totalprice_median
  FROM base b JOIN last3 l USING (o_custkey))
SELECT a.c_custkey, a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment, a.n_name, a.n_regionkey, a.is_train,
  f.* EXCLUDE (o_custkey)
FROM {fx.APPLICATION_SQL} a LEFT JOIN feats f ON a.c_custkey = f.o_custkey
"""


def flagship(spark, sf_dir):
    app = fx.application(spark, sf_dir)
    prev = fx.previous(spark, sf_dir)
    return history_features(app, prev, "o_custkey", "c_custkey", "o_totalprice", "o_orderstatus",
                            "F", "P", "day", "o_orderkey")


register("customer_history_features", FLAGSHIP_SQL,
         exact=["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey", "is_train",
                "hist_size"])(flagship)
