"""Inspection of the raw and silver layers: what to look at before trusting a new source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.errors import MissingInputError
from stationlake.operators import daily, profile
from stationlake.plans.run import Lake
from stationlake.session import stored
from stationlake.sources import checks, files, station_csv
from stationlake.sources.lines import file_lines

EXPECTED_COLUMNS = (schemas.DATE_COLUMN, schemas.TIME_COLUMN, *schemas.MEASURES)


def column_status(report: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """One row per file and expected column with status OK or MISSING, from the files' headers, and
    what the checks found wrong with the file."""
    names = F.explode(F.array(*[F.lit(c) for c in expected]))
    listed = report.select("path", "source_year", "problem", "header", names.alias("column_name"))
    present = F.coalesce(F.array_contains("header", F.col("column_name")), F.lit(False))
    return listed.select(
        "path",
        "source_year",
        "problem",
        "column_name",
        F.when(present, "OK").otherwise("MISSING").alias("status"),
    )


def inspect_raw(
    spark: SparkSession, lake: Lake, years: Sequence[int] | None = None
) -> dict[str, DataFrame]:
    """Per file year: ``columns`` present, ``rows`` (rows, distinct and repeated date/time pairs,
    24:00 rows) and ``measures`` (valid, missing and negative cells, range).

    Files that fail a check are examined like the others, as far as they have a header.
    """
    files.require_files(spark, lake.raw_readings, lake.readings_pattern)
    folders = files.year_folders(spark, lake.raw_readings, years)
    if not folders:
        raise MissingInputError(f"no folder of {years} below {lake.raw_readings}")
    # One scan: the report, and the rows that both profiles look at, come from the lines kept here.
    lines = file_lines(spark, folders, lake.readings_pattern).persist(StorageLevel.DISK_ONLY)
    listed = files.file_listing(spark, folders, lake.readings_pattern).select("path", "source_year", "length")
    report = stored(checks.csv_report(listed, lines), "inspected")
    readable = report.where(F.array_contains("header", schemas.DATE_COLUMN))
    rows = station_csv.read_station_csv(spark, readable, folders, accepted_only=False, lines=lines)
    raw = station_csv.data_rows(station_csv.classified_rows(rows))
    midnight = F.trim(F.col(schemas.TIME_COLUMN)) == "24:00"
    return {
        "columns": column_status(report),
        "rows": profile.key_profile(
            raw, [schemas.DATE_COLUMN, schemas.TIME_COLUMN], midnight, by=["source_year"]
        ).withColumnRenamed("flagged_rows", "midnight_rows"),
        "measures": profile.numeric_profile(raw, list(schemas.MEASURES), by=["source_year"]),
    }


def inspect_silver(spark: SparkSession, lake: Lake, year: int) -> dict[str, DataFrame]:
    """For one file year: the earliest rows as a ``sample``, ``completeness`` by pollutant, and the
    ``range`` of the timestamps. Only that year's folder is read."""
    readings = spark.read.parquet(lake.path("silver", "readings")).where(
        F.col("source_year") == year
    )
    return {
        "sample": daily.earliest(readings, ["recorded_at", "pollutant", "site_name"]),
        "completeness": daily.completeness_by(readings, ["pollutant"]),
        "range": daily.layer_counts(readings),
    }
