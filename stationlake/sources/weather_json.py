"""Reader for weather documents: one JSON object per file holding parallel arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.session import few_listing_tasks
from stationlake.sources.files import any_case, year_in_path


def read_weather_documents(
    spark: SparkSession,
    root: str,
    pattern: str = "*.json",
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """One row per file below ``root``, or in some of its ``folders``: ``hourly``, ``source_file`` and
    the ``source_year`` of its path."""
    with few_listing_tasks(spark):
        documents = (
            spark.read.schema(schemas.WEATHER_DOCUMENT)
            .option("multiLine", "true")
            .option("pathGlobFilter", any_case(pattern))
            .option("recursiveFileLookup", "true")
            .json(list(folders or [root]))
        )
    return documents.withColumn("source_file", F.col("_metadata.file_name")).withColumn(
        "source_year", year_in_path(F.col("_metadata.file_path"))
    )


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per array position. Check the arrays first (``weather_problems``). All other columns of ``documents`` are repeated on each row."""
    arrays = [F.col(f"hourly.{name}") for name in schemas.WEATHER_ARRAYS]
    rest = [c for c in documents.columns if c != "hourly"]
    flat = documents.select(*rest, F.inline(F.arrays_zip(*arrays)))
    return flat.withColumnRenamed("time", "recorded_at")
