"""Corpus pipeline: five stages over ``documents``, each one of the training-data operators.

``run(spark, sf_dir)`` applies the stages in order; what a stage returns is
written as Parquet to the shared checkpoint folder and reread as the next
stage's input.  All stages but the last return the columns of ``documents``;
a stage that changes texts sets ``n_chars`` anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherstack.llm import bpe, decontaminate, lines, minhash, quality
from featherstack.llm.common import crc_mod, stage_table

#: A quality classifier, near-duplicate components and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.3 go."""
    labels = _table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    return quality.predict(docs, model, threshold=0.3).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go from every document."""
    return _counted(lines.drop_common_lines(docs, min_docs=10, min_chars=1)).select(docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles, the smallest id stays."""
    found = minhash.near_duplicates(docs, shingle=5, percent=80)
    gone = found.where("NOT kept").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ten-word windows of benchmark items are cut from the texts."""
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return _counted(decontaminate.cut_spans(found)).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded=True)
    return done.select("doc_id", "n_tokens", "token_ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir))
    return docs
