"""A corpus made ready for training: language, lines, near-duplicates, benchmark leaks, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns to
the shared folder and reads it again for the next one. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import decontam, langid, linededup, packing, simhash
from stationlake.llm.common import written

#: None: no stage can be written in SQL. The stages are tested against brute-force versions.
ORACLE_SQL = None


def _kept(docs: DataFrame, annotate, condition) -> DataFrame:
    """The rows that meet the condition on the annotated texts; other columns travel apart from its names."""
    rest = [name for name in docs.columns if name != "text"]
    found = annotate(docs.select(F.struct(*rest).alias("row"), "text")).where(condition)
    return found.select(*(F.col("text") if n == "text" else F.col(f"row.`{n}`").alias(n) for n in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; a text that is null or has no letter is rejected.

    Without any labelled document to learn from, every text with a letter stays.
    """
    model = langid.fit_documents(docs)
    known = F.col("lang_pred") != langid.UNDETERMINED if model else F.col("text").rlike(r"\p{L}")
    return _kept(docs, lambda rows: langid.identify(rows, model, with_spans=False), known)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that resemble an earlier line; n_chars follows."""
    kept = linededup.without_repeated_lines(docs, threshold=0.8)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_of_each_group(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, lambda rows: decontam.find_leaks(rows, benchmark), ~F.col("contaminated"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document go in sequences of at most 2048."""
    return packing.pack_documents(docs, limit=2048, vocabulary="word_bpe_49k.json")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
