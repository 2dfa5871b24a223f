"""Connected components of an edge table by alternating stars.

Each round links every vertex's larger neighbours (large star) and then its
smaller ones (small star) to the smallest vertex it knows, until nothing
changes; rounds grow with the logarithm of the longest path.  Minima are
combined map-side and joined back with ``skew.split_join``, which deals the rows
of a hub to several tasks (AQE can't split a join side that was just aggregated
by the hub).  Each round's edges are written to the shared folder.

Cases: edges with a NULL end, loops and repeated edges add nothing; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import split_join
from .common import stage_table


def _sum(edges: DataFrame) -> tuple:
    """A checksum of the edges as a set."""
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (u, v); the component is its smallest vertex."""
    now = stage_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _sum(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = split_join(both.where("v > u"), low, "u", "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, low, "u", "inner").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stage_table(small.select("e.*").where("u <> v").distinct())
        after = _sum(now)
        if after == before:
            break
        before = after
    centres = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
