"""Table scans and train/test assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.clean import nan_to_null


def scan_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               columns: Sequence[str] | None = None, limit: int | None = None,
               order: Sequence[str] | None = None, fmt: str | None = None,
               clean_nan: bool = True) -> DataFrame:
    """Read one table.

    * ``fmt`` defaults from the path (``.csv`` → CSV with a header row, else
      Parquet).  CSV always takes an explicit schema at scale; inference is
      only a convenience for small files.
    * ``columns`` prunes the read (Catalyst pushes it into ``ReadSchema``).
    * ``limit`` is the debug-sample feature (``nrows``): with ``order`` it is
      a deterministic top-n, otherwise any n rows.
    * ``clean_nan`` turns NaN into NULL right at the source.
    """
    fmt = fmt or ("csv" if path.endswith((".csv", ".csv.gz")) else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.format(fmt).load(path)
    if columns is not None:
        df = df.select(*columns)
    if clean_nan:
        df = nan_to_null(df)
    if limit is not None:
        df = (df.orderBy(*order) if order else df).limit(limit)
    return df


def union_train_test(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """Append test rows to train rows; columns missing on one side become NULL."""
    return (train.withColumn(flag, F.lit(True))
            .unionByName(test.withColumn(flag, F.lit(False)), allowMissingColumns=True))


def split_train_test(df: DataFrame, flag: str = "is_train") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(flag)), df.where(~F.col(flag))
