"""Flagship plan: entity ⟕ per-entity history features.

count, sum/mean/max/median of the amount; the same for the approved and the
refused subsets with their ratios; slope of amount over day; refused share —
all in ONE aggregate pass keyed by the entity.  The last-3 mean needs ranked
rows (two-phase salted top-k) and is the only other pass; the two results
are joined by key and then once onto the entity table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import feature_name
from ..operators.agg import _pairs, agg_exprs, picks, subset_parts
from ..operators.ordered import last_k_agg, trend_exprs
from ..operators.select import aggregate


def history_features(entity: DataFrame, history: DataFrame, key: str, entity_key: str, amount: str,
                     status: str, approved, refused, day: str, tiebreak: str, amount_scale: int | None = 2) -> DataFrame:
    spec = {amount: ["sum", "mean", "max", "median"]}
    scales = {amount: amount_scale} if amount_scale is not None else None
    subsets = {"appr": f"`{status}` = '{approved}'", "refu": f"`{status}` = '{refused}'"}
    sub_aggs, sub_outs, sub_picks = subset_parts(spec, subsets, ratios=[("appr", "refu")], scales=scales)
    plain = [F.count(F.lit(1)).alias("hist_size"),
             *agg_exprs(spec, "hist", scales=scales),
             F.avg(F.coalesce(F.col(status) == F.lit(refused), F.lit(False)).cast("int")).alias("hist_refused_share"),
             *trend_exprs(amount, day, "hist", intercept=False)]
    plain_names = (["hist_size"] + [feature_name("hist", c, fn) for c, fn in _pairs(spec)]
                   + ["hist_refused_share", feature_name("hist", amount, "slope")])
    fused = aggregate(history, key, [*plain, *sub_aggs], [*picks(spec, "hist"), *sub_picks]).select(key, *plain_names, *sub_outs)
    last3 = last_k_agg(history, key, [F.col(day).desc(), F.col(tiebreak).desc()], {amount: ["mean"]}, [3], "hist",
                       salt_cols=[tiebreak], scales=scales)
    feats = fused.join(last3, key)
    return entity.join(feats.withColumnRenamed(key, entity_key), entity_key, "left")
