import os
import sys

import pytest

from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def make(rows):
        table = spark.createDataFrame([(i, t, "en") for i, t in rows], DOCUMENTS)
        return table.selectExpr("*", "'x' as fp", "1 as bucket", "2 as task", "'y' as ord", "3 as key", "4 as part")

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """The given documents, as a DataFrame and as a list of (doc_id, text)."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table, [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]


ODD = [
    (1, None),
    (2, ""),
    (3, "one two three four five"),
    (3, "one two three four five"),
    (4, "word " * 30_000),
    (5, "  \n\t "),
    (None, "one two three four five"),
    (7, "ünï çødé 你好 世界 Привет мир " * 20),
    (8, "x" * 50_000),
]


@pytest.fixture
def odd(frame):
    return frame(ODD), list(ODD)
