"""Registered queries: daily metrics, samples, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.catalog import adapters
from stationlake.catalog.registry import registered
from stationlake.operators import colocated, daily, enrich, layout
from stationlake.plans import layers
from stationlake.session import scratch_dir


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare six decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


WEATHER_MEANS = (
    "avg_temperature_2m",
    "avg_relative_humidity_2m",
    "total_precipitation",
    "avg_pressure_msl",
    "avg_wind_speed_10m",
)
ROUNDED_WEATHER_SQL = ", ".join(f"ROUND({c}, 6) AS {c}" for c in WEATHER_MEANS)

_DAILY_ROUNDED = (
    f"WITH {adapters.DAILY_SQL} SELECT * REPLACE (ROUND(avg_value, 6) AS avg_value) FROM daily"
)


@registered("daily_completeness", _DAILY_ROUNDED)
def daily_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily.daily_readings(adapters.readings(spark, sf_dir)), "avg_value")


@registered(
    "daily_weather",
    f"WITH {adapters.DAILY_WEATHER_SQL} SELECT * REPLACE ({ROUNDED_WEATHER_SQL}) FROM daily_weather",
)
def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily.daily_weather(adapters.order_weather(spark, sf_dir)), *WEATHER_MEANS)


@registered(
    "completeness_by_key",
    f"""WITH {adapters.READINGS_SQL}
SELECT pollutant, n AS total_rows, coalesce(good, 0) AS valid_readings, n - coalesce(good, 0) AS missing_readings,
       round(100.0 * coalesce(good, 0) / n, 2) AS completeness_pct
FROM (SELECT pollutant, count(*) AS n FROM readings GROUP BY ALL)
LEFT JOIN (SELECT pollutant, count(*) AS good FROM readings WHERE value IS NOT NULL GROUP BY ALL) USING (pollutant)""",
)
def completeness_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.completeness_by(adapters.readings(spark, sf_dir), ["pollutant"])


@registered(
    "layer_counts",
    f"""WITH {adapters.READINGS_SQL}
SELECT n AS total_rows, good AS valid_readings, n - good AS missing_readings, since AS min_recorded_at,
       until AS max_recorded_at
FROM (SELECT count(*) AS n FROM readings), (SELECT count(*) AS good FROM readings WHERE value IS NOT NULL),
     (SELECT recorded_at AS since FROM readings ORDER BY 1 LIMIT 1),
     (SELECT recorded_at AS until FROM readings ORDER BY 1 DESC LIMIT 1)""",
)
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.layer_counts(adapters.readings(spark, sf_dir))


@registered(
    "topk_sample",
    f"""WITH {adapters.READINGS_SQL}
SELECT recorded_at, site_name, pollutant, value, event_id
FROM readings ORDER BY recorded_at, pollutant, event_id LIMIT 30""",
)
def topk_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = daily.earliest(
        adapters.readings(spark, sf_dir), ["recorded_at", "pollutant", "event_id"], 30
    )
    return sample.select("recorded_at", "site_name", "pollutant", "value", "event_id")


@registered("sorted_output", _DAILY_ROUNDED)
def sorted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = daily.daily_readings(adapters.readings(spark, sf_dir))
    return layout.sorted_files(
        rounded(gold, "avg_value"), ["reading_date", "pollutant", "site_name"]
    )


_HOURLY_SQL = f"""WITH {adapters.SHIPPED_SQL}
SELECT {adapters.HOURLY_COLUMNS_SQL}
FROM shipped r LEFT JOIN weather w ON r.recorded_at = w.recorded_at"""


@registered("hourly_enrich_left", _HOURLY_SQL)
def hourly_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.hourly_environment(
        adapters.shipped_readings(spark, sf_dir), adapters.weather_per_date(spark, sf_dir)
    )


@registered("hourly_enrich_shuffled", _HOURLY_SQL)
def hourly_enrich_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result by a shuffle of both sides, as when the weather is too large to broadcast."""
    return layers.hourly_environment(
        adapters.shipped_readings(spark, sf_dir),
        adapters.weather_per_date(spark, sf_dir),
        join_hint="merge",
    )


@registered("hourly_enrich_bucketed", _HOURLY_SQL)
def hourly_enrich_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result from two tables bucketed by hour: written once, joined without a shuffle."""
    readings = colocated.bucketed(adapters.shipped_readings(spark, sf_dir), ["recorded_at"], 16)
    weather = colocated.bucketed(adapters.weather_per_date(spark, sf_dir), ["recorded_at"], 16)
    return layers.hourly_environment(readings, weather)


@registered(
    "sorted_ranges",
    f"""WITH {adapters.READINGS_SQL}
SELECT count(*) AS total_rows, min(recorded_at) AS first_hour, max(recorded_at) AS last_hour,
       0::BIGINT AS overlapping_files
FROM readings""",
)
def sorted_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted table as its files show it: each file begins where the one before it has ended."""
    order = ["recorded_at", "pollutant", "site_name", "event_id"]
    path = scratch_dir(spark, "sorted")
    rows = adapters.readings(spark, sf_dir).select(*order, "value")
    layout.sorted_files(rows, order).write.parquet(path)
    ranges = layout.file_ranges(spark.read.parquet(path), order)
    return ranges.agg(
        F.sum("rows").alias("total_rows"),
        F.min("lowest.recorded_at").alias("first_hour"),
        F.max("highest.recorded_at").alias("last_hour"),
        F.count_if(~F.col("follows")).alias("overlapping_files"),
    )


@registered(
    "hourly_enrich_cities",
    f"""WITH {adapters.SHIPPED_SQL}
SELECT {adapters.HOURLY_COLUMNS_SQL}
FROM shipped r LEFT JOIN site_nations s ON r.site_name = s.site_name
LEFT JOIN nation_weather w ON r.recorded_at = w.recorded_at AND s.city = w.city""",
)
def hourly_enrich_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.hourly_environment(
        adapters.shipped_readings(spark, sf_dir),
        adapters.weather_per_date_and_nation(spark, sf_dir),
        adapters.site_nations(spark, sf_dir),
    )


@registered(
    "join_coverage",
    f"""WITH {adapters.SHIPPED_SQL}
SELECT n AS total_rows, found AS matched_rows, n - found AS unmatched_rows, round(100.0 * found / n, 2) AS match_pct
FROM (SELECT count(*) AS n FROM shipped),
     (SELECT count(*) AS found FROM shipped SEMI JOIN weather ON shipped.recorded_at = weather.recorded_at
                                                       AND weather.temperature_2m IS NOT NULL)""",
)
def join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.match_coverage(hourly_enrich_left(spark, sf_dir), "temperature_2m")
