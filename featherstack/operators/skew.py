"""Joining per-key tables back onto rows when a few keys hold most of the rows.

AQE splits a hot partition of a join only where both sides end in a shuffle of
their own; a side that was just aggregated by the join's keys does not, so all
rows of a hot key would meet in one task.  Here the rows decide for themselves:

1. A counting sketch, one row of BUCKETS counters of key hashes, is an ordinary
   partial aggregate.  A counter bounds the rows of every key in its bucket
   from above.
2. A bucket with more than one ``cuts``-th of all rows is heavy, and gets as
   many parts as it has ``cuts``-ths.  Its rows are dealt to the parts by a hash
   of the whole row, and the right side's rows of that bucket are repeated, one
   for each part; all other rows join as they are.

The sketch is a scalar subquery of the plan (at most ``cuts`` entries), so
nothing runs before the query does and nothing reaches the driver.  No task is
dealt much more than a ``cuts``-th of the rows for any key, whatever it is; a
key that shares a heavy bucket by chance is only repeated for nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
CUTS = 64


def bucket_of(keys: Sequence[str]) -> Column:
    """The counter that a row's keys fall into."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BUCKETS)).cast("int")


def heavy_buckets(rows: DataFrame, keys: Sequence[str], cuts: int = CUTS) -> DataFrame:
    """One row: a map of each heavy bucket to its number of parts."""
    counts = rows.groupBy(bucket_of(keys).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    one = counts.agg(F.collect_list(F.struct("b", "c")).alias("l"), F.sum("c").alias("n"))  # at most BUCKETS entries
    return one.select(F.expr(f"""map_from_entries(transform(filter(l, x -> x.c * {cuts} > n),
        x -> named_struct('b', x.b, 'parts', CAST(ceil(x.c * {cuts} / n) AS INT)))) AS parts"""))


def split_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left", rows: DataFrame | None = None,
               cuts: int = CUTS) -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left) with the rows of heavy keys spread over several tasks.

    ``rows`` may name the frame that ``left`` was widened from, row by row: the
    sketch then counts its keys, and its columns tell the parts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("left", "inner"):
        raise ValueError(f"rows of the right side are repeated: no {how} join")
    source = left if rows is None else rows
    sketch = heavy_buckets(source, keys, cuts)
    parts = F.coalesce(F.element_at(sketch.scalar(), bucket_of(keys)), F.lit(1))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c, t in source.dtypes if "map<" not in t])
    dealt = left.withColumn("__part", F.pmod(whole, parts).cast("int"))
    copies = right.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")
