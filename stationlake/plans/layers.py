"""The layers as DataFrame plans. Nothing here writes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.cells import is_nonblank
from stationlake.functions.clock import at_clock, parse_date
from stationlake.operators import daily, enrich
from stationlake.operators.cleaning import clean_readings, stamp
from stationlake.operators.reshape import unpivot_measures


def with_lineage(rows: DataFrame, **constants: Column | str) -> DataFrame:
    """All source columns plus constant or computed lineage columns."""
    return rows.select(
        "*", *[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in constants.items()]
    )


def silver_readings(
    bronze: DataFrame,
    measures: Mapping[str, str] = schemas.MEASURES,
    unit: str = schemas.MEASURE_UNIT,
    strict: bool = True,
    nan_policy: str = "keep",
) -> DataFrame:
    """Bronze station rows (text cells) to long readings.

    The timestamp is computed once per wide row, before the rows are multiplied. ``year`` is the
    year of the file, so the last hour of 31 December keeps the year it was delivered in.
    """
    dated = bronze.where(is_nonblank(F.col(schemas.DATE_COLUMN)))
    stamped = stamp(dated, schemas.DATE_COLUMN, schemas.TIME_COLUMN, strict=strict)
    ids = ["recorded_at", "site_name", "source_year", "source_file"]
    long = unpivot_measures(stamped, ids, measures, value_column="cell")
    return clean_readings(long, nan_policy=nan_policy).select(
        "recorded_at",
        "site_name",
        "pollutant",
        "value",
        F.lit(unit).alias("unit"),
        F.col("source_year").cast("int").alias("year"),
        "source_file",
        "source_year",
    )


def quarantined_times(bronze: DataFrame) -> DataFrame:
    """Bronze rows whose date or time cannot be used: what ``strict=False`` leaves out."""
    day, clock = F.col(schemas.DATE_COLUMN), F.col(schemas.TIME_COLUMN)
    reason = F.when(parse_date(day).isNull(), "bad_date").when(
        ~F.coalesce(at_clock(parse_date(day), clock, strict=False).isNotNull(), F.lit(False)),
        "bad_time",
    )
    return (
        bronze.where(is_nonblank(day))
        .select("source_file", schemas.DATE_COLUMN, schemas.TIME_COLUMN, reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def silver_weather(bronze: DataFrame) -> DataFrame:
    """Bronze weather rows to typed rows; ``year`` is the year of the timestamp."""
    return bronze.where(F.col("recorded_at").isNotNull()).select(
        F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"),
        "city",
        *[F.col(m).try_cast("double").alias(m) for m in schemas.WEATHER_MEASURES],
        F.year(F.col("recorded_at").cast("timestamp_ntz")).alias("year"),
        "source_name",
        "source_year",
        "source_file",
    )


def hourly_environment(
    readings: DataFrame,
    weather: DataFrame,
    site_cities: DataFrame | None = None,
    join_hint: str | None = None,
) -> DataFrame:
    """Readings with the weather of the same hour; readings without a match keep NULLs.

    With one city the key is the timestamp. With several, ``site_cities`` (site_name, city) names
    the city of each site and the key is (recorded_at, city). ``join_hint`` fixes the kind of the join
    with the weather, which Spark chooses otherwise.
    """
    keys: Sequence[str] = ["recorded_at"]
    columns = ["recorded_at", "city", *schemas.WEATHER_MEASURES]
    left = readings.select("recorded_at", "site_name", "pollutant", "value", "unit")
    right = weather.select(*columns)
    if site_cities is not None:
        left = enrich.left_join_unique(left, site_cities, ["site_name"])
        left = left.withColumnRenamed("city", "site_city")
        right = right.withColumn("site_city", F.col("city"))
        keys = ["recorded_at", "site_city"]
    if join_hint:
        right = right.hint(join_hint)
    joined = enrich.left_join_unique(left, right, keys)
    return joined.select(
        "recorded_at",
        F.col("recorded_at").cast("date").alias("reading_date"),
        "site_name",
        "city",
        "pollutant",
        F.col("value").alias("pollutant_value"),
        F.col("unit").alias("pollutant_unit"),
        *schemas.WEATHER_MEASURES,
        F.year("recorded_at").alias("year"),
        F.month("recorded_at").alias("month"),
    )


def touched_months(
    file_years: Sequence[int], partition_by: Sequence[str] = schemas.HOURLY_PARTITIONS
) -> list[tuple[int, int]]:
    """(year, month) of the partitions that a refresh of ``file_years`` can change.

    The last hour in the file of year Y is stamped 1 January of Y+1. In a table split by year that
    day shares its partition with the whole of Y+1.
    """
    reach = 1 if "month" in partition_by else 12
    months = {(year, month) for year in file_years for month in range(1, 13)}
    return sorted(months | {(y + 1, m) for y in file_years for m in range(1, reach + 1)})


def in_months(year: Column, month: Column, months: Sequence[tuple[int, int]]) -> Column:
    """True for rows in one of ``months``. On partition columns it prunes folders."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    hit = F.lit(False)
    for y, some in by_year.items():
        hit = hit | ((year == y) & month.isin(*some))
    return hit


def month_spans(months: Sequence[tuple[int, int]]) -> list[tuple[dt.date, dt.date]]:
    """The months as spans [first day, day after the last); months in sequence share one span."""
    spans: list[tuple[dt.date, dt.date]] = []
    for year, month in sorted(months):
        first = dt.date(year, month, 1)
        end = dt.date(year + month // 12, month % 12 + 1, 1)
        if spans and spans[-1][1] == first:
            first = spans.pop()[0]
        spans.append((first, end))
    return spans


def rows_of_months(silver: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Silver rows of the given months. They lie in the files of those years and the years before:
    the filter on ``source_year`` keeps Spark from opening the others, and the spans of time are
    plain comparisons, which the Parquet reader uses to skip row groups."""
    folders = sorted({year - back for year, _ in months for back in (0, 1)})
    in_span = F.lit(False)
    for first, end in month_spans(months):
        at = F.col("recorded_at")
        since, until = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in (first, end))
        in_span = in_span | ((at >= since) & (at < until))
    return silver.where(F.col("source_year").isin(*folders) & in_span)
