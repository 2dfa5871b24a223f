import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, first=0):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts, first)]
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture
def rng():
    return random.Random(5)
