"""Prediction stores: many per-model files read as ONE scan.

The reference lists ``*_oof_train.csv`` files and reads them in a loop; here a
single glob scan reads them all and the model id comes from each row's file
path (the file-source ``_metadata`` column), so the read is one distributed
job however many models there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_glob_predictions(spark: SparkSession, pattern: str, schema: StructType | str, model_regex: str,
                          fmt: str = "csv") -> DataFrame:
    """Read every file matching ``pattern``; ``model_regex`` (one group)
    extracts the model id from the file's path."""
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(pattern) if fmt == "csv" else reader.format(fmt).load(pattern)
    return df.withColumn("model", F.regexp_extract(F.col("_metadata.file_path"), model_regex, 1))


def write_model_predictions(df: DataFrame, root: str, model: str, suffix: str = "_oof_train.csv") -> str:
    """One folder of CSV parts per model, named ``<model><suffix>`` under ``root``
    (the layout the glob reader expects); every task writes its own part."""
    path = f"{root.rstrip('/')}/{model}{suffix}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
