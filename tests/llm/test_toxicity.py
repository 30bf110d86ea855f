import zlib

import numpy as np
from pyspark.sql import types as T

from stationlake.llm.toxicity import Lexicon, score_documents

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()), T.StructField("score", T.DoubleType())])


def rank_quality(rows):
    """Part of the pairs of a toxic and a clean document that the score puts in order."""
    bad = np.array([r[0] for r in rows if r[1]])
    good = np.array([r[0] for r in rows if not r[1]])
    return ((bad[:, None] > good).mean() + (bad[:, None] >= good).mean()) / 2


def test_held_out_quality(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = {r.doc_id: r for r in score_documents(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    truth = [(found[r.doc_id], r.toxic) for r in labels.collect() if r.toxic is not None]
    held = [(r.score, toxic) for r, toxic in truth if r.held_out]
    assert rank_quality(held) > 0.9


def test_features():
    lexicon = Lexicon({"idiot": 3.0, "lowe-": 2.5})
    names = __import__("stationlake.llm.toxicity", fromlist=["FEATURES"]).FEATURES
    found = dict(zip(names, lexicon.features("You IDIOT! loweiung id1ot sooo far")))
    assert found["lexicon_density"] > 0 and found["stem_density"] > 0 and found["near_second_person"] > 0
    assert found["shouted_words"] > 0 and found["disguised_hits"] > 0 and found["stretched"] > 0
    assert lexicon.features("") == lexicon.features("  ") and len(lexicon.features("")) == len(names)


def test_odd_rows(spark, odd, frame):
    table, rows = odd
    labels = spark.createDataFrame([(1, 1, 0.0), (2, 0, 0.0), (3, None, 0.0), (3, 1, 0.0), (None, 1, 0.0), (4, 0, 0.0)], LABELS)
    found = score_documents(table, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    none = score_documents(table, spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    one = spark.createDataFrame([(k, 1, 0.0) for k in range(20)], LABELS)
    assert {r.score for r in score_documents(table, one).collect()} == {1.0}
    assert score_documents(frame([]), labels).count() == 0
