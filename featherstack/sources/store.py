"""A feature store of tables bucketed by their key.

Every family is written once, hashed by the key into the same number of buckets
and sorted by it; families of one store then join by key without moving a row,
now and in later sessions that name the same store.  Families are computed
``workers`` at a time, as each is a series of jobs that alone would leave most
of a cluster idle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORKERS = 4


class FeatureStore:
    """Tables ``<name>_<family>`` in the session's catalog, one row for each key."""

    def __init__(self, spark: SparkSession, key: str, name: str | None = None, buckets: int | None = None):
        self.spark, self.key = spark, key
        self.name = name or f"features_{uuid.uuid4().hex[:12]}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def table(self, family: str) -> str:
        return f"{self.name}_{family}"

    def write(self, family: str, df: DataFrame) -> DataFrame:
        """``df`` written as the family's table: one file a bucket, by key."""
        dealt = df.repartition(self.buckets, F.col(f"`{self.key}`"))
        dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.table(family))
        return self.read(family)

    def read(self, family: str) -> DataFrame:
        return self.spark.table(self.table(family))

    def write_all(self, families: Mapping[str, Callable[[], DataFrame]], workers: int = WORKERS) -> dict[str, DataFrame]:
        """All families, ``workers`` at a time."""
        with ThreadPoolExecutor(workers) as pool:
            return dict(zip(families, pool.map(lambda kv: self.write(kv[0], kv[1]()), families.items()), strict=True))

    def join(self, first: str, others: list[str]) -> DataFrame:
        """The first family's rows with every other one's columns; a column that
        an earlier family has already is left out."""
        out = self.read(first)
        for family in others:
            f = self.read(family)
            out = out.join(f.select(self.key, *[c for c in f.columns if c not in out.columns]), self.key, "left")
        return out

    def drop(self) -> None:
        for t in self.spark.catalog.listTables():
            if t.name.startswith(f"{self.name}_"):
                self.spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
