"""Daily metrics with completeness, and the layer summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness(valid: Column, total: Column) -> Column:
    """Share of valid readings in percent, two decimals; NULL for no rows."""
    return F.round(F.try_divide(valid * F.lit(100.0), total), 2)


def _counts(value: str, valid: str, expected: str, missing: str, pct: str) -> list[Column]:
    total = F.count(F.lit(1))
    present = F.count(F.col(value))
    return [
        total.alias(expected),
        present.alias(valid),
        (total - present).alias(missing),
        completeness(present, total).alias(pct),
    ]


def _calendar(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("reading_date")).withColumn("month", F.month("reading_date"))


def daily_readings(readings: DataFrame) -> DataFrame:
    """Per (reading_date, site_name, pollutant): mean, range, and counts.

    ``expected_readings`` is the number of rows present. A NaN reading stays in the mean and is the
    largest value, as in the source system.
    """
    per_day = (
        readings.select(
            F.col("recorded_at").cast("date").alias("reading_date"),
            "site_name",
            "pollutant",
            "value",
        )
        .groupBy("reading_date", "site_name", "pollutant")
        .agg(
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            *_counts(
                "value",
                "valid_readings",
                "expected_readings",
                "missing_readings",
                "completeness_pct",
            ),
        )
    )
    return _calendar(per_day)


def daily_weather(weather: DataFrame) -> DataFrame:
    """Per (reading_date, city): weather means, range and total, and temperature completeness."""
    per_day = (
        weather.withColumn("reading_date", F.col("recorded_at").cast("date"))
        .groupBy("reading_date", "city")
        .agg(
            F.avg("temperature_2m").alias("avg_temperature_2m"),
            F.min("temperature_2m").alias("min_temperature_2m"),
            F.max("temperature_2m").alias("max_temperature_2m"),
            F.avg("relative_humidity_2m").alias("avg_relative_humidity_2m"),
            F.sum("precipitation").alias("total_precipitation"),
            F.avg("pressure_msl").alias("avg_pressure_msl"),
            F.avg("wind_speed_10m").alias("avg_wind_speed_10m"),
            *_counts(
                "temperature_2m",
                "valid_temperature_readings",
                "expected_readings",
                "missing_temperature_readings",
                "temperature_completeness_pct",
            ),
        )
    )
    return _calendar(per_day)


def completeness_by(readings: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Per key: total_rows, valid_readings, missing_readings, completeness_pct."""
    return readings.groupBy(*keys).agg(
        *_counts(value, "valid_readings", "total_rows", "missing_readings", "completeness_pct")
    )


def layer_counts(readings: DataFrame, value: str = "value", at: str = "recorded_at") -> DataFrame:
    """One row: number of rows, of valid and missing readings, and the time range."""
    total = F.count(F.lit(1))
    return readings.agg(
        total.alias("total_rows"),
        F.count(value).alias("valid_readings"),
        (total - F.count(value)).alias("missing_readings"),
        F.min(at).alias("min_recorded_at"),
        F.max(at).alias("max_recorded_at"),
    )


def earliest(readings: DataFrame, order: Sequence[str], rows: int = 30) -> DataFrame:
    """The first ``rows`` rows in ``order``: a sample to look at. Runs as a per-task top-k."""
    return readings.orderBy(*order).limit(rows)
