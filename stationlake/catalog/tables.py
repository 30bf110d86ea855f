"""Registered queries: writing, publishing, and reading back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.catalog import adapters
from stationlake.catalog.metrics import ROUNDED_WEATHER_SQL, WEATHER_MEANS, rounded
from stationlake.catalog.registry import registered, table
from stationlake.functions.clock import hour_floor
from stationlake.operators.cleaning import clean_readings
from stationlake.operators import daily, keys, layout, serving
from stationlake.plans.run import TABLES, publish_table
from stationlake.session import scratch_dir

_CHANGED_FROM = "2024-01-15"


@registered(
    "upsert_daily",
    f"""WITH {adapters.DAILY_SQL},
target AS (SELECT * REPLACE (max_value + 1000 AS max_value) FROM daily WHERE reading_date < DATE '2024-01-20'),
changes AS (SELECT * REPLACE (CASE WHEN pollutant <> 'view' THEN max_value END AS max_value)
            FROM daily WHERE reading_date >= DATE '{_CHANGED_FROM}'),
merged AS (
    SELECT * FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM changes c WHERE c.reading_date = t.reading_date
          AND c.site_name = t.site_name AND c.pollutant = t.pollutant)
    UNION ALL SELECT * FROM changes)
SELECT * REPLACE (ROUND(avg_value, 6) AS avg_value, CAST(valid_readings AS INTEGER) AS valid_readings,
                  CAST(expected_readings AS INTEGER) AS expected_readings,
                  CAST(missing_readings AS INTEGER) AS missing_readings)
FROM merged""",
)
def upsert_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier deliveries of the daily metrics, then later ones; an update may set NULL."""
    gold = rounded(daily.daily_readings(adapters.readings(spark, sf_dir)), "avg_value")
    staged = layout.as_table(gold, schemas.DAILY_READINGS_COLUMNS)
    day, highest = F.col("reading_date"), F.col("max_value")
    target = staged.where(day < F.lit("2024-01-20").cast("date")).withColumn(
        "max_value", highest + 1000
    )
    changes = staged.where(day >= F.lit(_CHANGED_FROM).cast("date")).withColumn(
        "max_value", F.when(F.col("pollutant") != "view", highest)
    )
    keys.enforce_key(changes, schemas.DAILY_READINGS_KEY)
    return serving.upsert(target, changes, schemas.DAILY_READINGS_KEY)


def _hourly_gold(spark: SparkSession, sf_dir: str, raised: bool) -> DataFrame:
    """Highest reading per hour, station and type in the shape of the hourly serving table."""
    moment = hour_floor(F.col("ts"))
    value = F.max("value") + (1000 if raised else 0)
    rows = (
        table(spark, sf_dir, "events")
        .groupBy(
            moment.alias("recorded_at"),
            adapters.site(F.col("user_id")).alias("site_name"),
            F.col("event_type").alias("pollutant"),
        )
        .agg(value.alias("pollutant_value"), F.min("value").alias("temperature_2m"))
    )
    return rows.select(
        "recorded_at",
        F.col("recorded_at").cast("date").alias("reading_date"),
        "site_name",
        F.lit("Main city").alias("city"),
        "pollutant",
        "pollutant_value",
        F.lit(schemas.MEASURE_UNIT).alias("pollutant_unit"),
        "temperature_2m",
        *[F.lit(None).cast("double").alias(m) for m in schemas.WEATHER_MEASURES[1:]],
        F.year("recorded_at").alias("year"),
        F.month("recorded_at").alias("month"),
    )


_HOURLY_SQL = """hourly AS (
    SELECT date_trunc('hour', ts) AS recorded_at, CAST(date_trunc('hour', ts) AS DATE) AS reading_date,
           'site-' || CAST(user_id % 4 AS VARCHAR) AS site_name, 'Main city' AS city,
           event_type AS pollutant, MAX(value) AS pollutant_value, 'ugm-3' AS pollutant_unit,
           MIN(value) AS temperature_2m, CAST(NULL AS DOUBLE) AS relative_humidity_2m,
           CAST(NULL AS DOUBLE) AS precipitation, CAST(NULL AS DOUBLE) AS pressure_msl,
           CAST(NULL AS DOUBLE) AS wind_speed_10m,
           CAST(EXTRACT(YEAR FROM date_trunc('hour', ts)) AS INTEGER) AS year,
           CAST(EXTRACT(MONTH FROM date_trunc('hour', ts)) AS INTEGER) AS month
    FROM events GROUP BY 1, 2, 3, 5, 13, 14)"""


def _publish_hourly(rows: DataFrame, path: str) -> int:
    return publish_table(rows, path, TABLES["hourly_environment"])


def _as_lake_times(rows: DataFrame) -> DataFrame:
    return rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@registered(
    "upsert_hourly",
    f"""WITH {_HOURLY_SQL}
SELECT * REPLACE (CASE WHEN reading_date < DATE '{_CHANGED_FROM}' THEN pollutant_value
                       ELSE pollutant_value + 1000 END AS pollutant_value)
FROM hourly""",
)
def upsert_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishes to a new serving table; the second one revises its later half."""
    path = scratch_dir(spark, "hourly")
    _publish_hourly(_hourly_gold(spark, sf_dir, raised=False), path)
    revised = _hourly_gold(spark, sf_dir, raised=True)
    _publish_hourly(revised.where(F.col("reading_date") >= F.lit(_CHANGED_FROM).cast("date")), path)
    return _as_lake_times(serving.read_table(spark, path, schemas.HOURLY_COLUMNS))


@registered(
    "upsert_idempotent",
    f"""WITH {adapters.DAILY_WEATHER_SQL}
SELECT * REPLACE ({ROUNDED_WEATHER_SQL}, CAST(expected_readings AS INTEGER) AS expected_readings,
                  CAST(valid_temperature_readings AS INTEGER) AS valid_temperature_readings,
                  CAST(missing_temperature_readings AS INTEGER) AS missing_temperature_readings)
FROM daily_weather""",
)
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing the same rows twice leaves what publishing them once does."""
    path = scratch_dir(spark, "weather")
    gold = daily.daily_weather(adapters.order_weather(spark, sf_dir))
    for _ in range(2):
        publish_table(gold, path, TABLES["daily_weather"])
    return rounded(serving.read_table(spark, path, schemas.DAILY_WEATHER_COLUMNS), *WEATHER_MEANS)


@registered(
    "serving_slice",
    f"""WITH {_HOURLY_SQL}
SELECT recorded_at, site_name, pollutant_value FROM hourly
WHERE pollutant = 'purchase' AND year = 2024 AND month = 1
  AND recorded_at >= TIMESTAMP '2024-01-10 00:00:00'""",
)
def serving_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader's filter: year and month choose folders, and the files are sorted by pollutant and
    time, so their statistics let the Parquet reader skip row groups."""
    path = scratch_dir(spark, "slice")
    _publish_hourly(_hourly_gold(spark, sf_dir, raised=False), path)
    rows = serving.read_table(spark, path, schemas.HOURLY_COLUMNS).where(
        (F.col("pollutant") == "purchase")
        & (F.col("year") == 2024)
        & (F.col("month") == 1)
        & (F.col("recorded_at") >= F.lit("2024-01-10 00:00:00").cast("timestamp"))
    )
    return _as_lake_times(rows).select("recorded_at", "site_name", "pollutant_value")


@registered(
    "serving_lookup",
    f"""WITH {_HOURLY_SQL}
SELECT recorded_at, site_name, pollutant, pollutant_value FROM hourly
WHERE site_name = 'site-2' AND recorded_at IN (
    SELECT date_trunc('hour', ts) FROM events WHERE user_id % 4 = 2 ORDER BY ts, event_id LIMIT 1)""",
)
def serving_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site at one hour, whatever its partition: Bloom filters of both columns tell files that hold
    neither, page and row group statistics do the rest."""
    path = scratch_dir(spark, "lookup")
    _publish_hourly(_hourly_gold(spark, sf_dir, raised=False), path)
    events = table(spark, sf_dir, "events").where("user_id % 4 = 2")
    hour = events.orderBy("ts", "event_id").select(hour_floor(F.col("ts")).cast("timestamp").alias("hour")).first().hour
    rows = serving.read_table(spark, path, schemas.HOURLY_COLUMNS).where(
        (F.col("site_name") == "site-2") & (F.col("recorded_at") == F.lit(hour))
    )
    return _as_lake_times(rows).select("recorded_at", "site_name", "pollutant", "pollutant_value")


@registered(
    "export_csv_null",
    f"""WITH {adapters.READINGS_SQL}
SELECT event_id, pollutant, value, cell FROM readings JOIN text_readings USING (event_id, pollutant)""",
)
def export_csv_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported rows read back with ``\\N`` as NULL."""
    path = scratch_dir(spark, "export")
    text = adapters.text_readings(spark, sf_dir).select("event_id", "pollutant", "cell")
    rows = clean_readings(text.withColumn("delivered", F.col("cell")), "delivered").select(
        "event_id", "pollutant", "value", "cell"
    )
    layout.export_csv(rows, path)
    return (
        spark.read.schema("event_id bigint, pollutant string, value double, cell string")
        .option("nullValue", "\\N")
        .csv(path)
    )


@registered(
    "partition_overwrite",
    """SELECT CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS source_year, l_returnflag,
       COUNT(*) AS total_rows,
       SUM(CASE WHEN l_shipdate >= DATE '2000-01-01' THEN l_quantity + 100 ELSE l_quantity END) AS quantity
FROM lineitem WHERE EXTRACT(YEAR FROM l_shipdate) <> 2001 GROUP BY 1, 2""",
)
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years are written, then the recent ones are delivered again and replaced. The new delivery
    has no rows of one of its years, so that year goes."""
    path = scratch_dir(spark, "years")
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("source_year"), "l_returnflag", "l_quantity"
    )
    layout.replace_partitions(lines, path, ["source_year"], ["l_returnflag"])
    redelivered = lines.where("source_year >= 2000 AND source_year <> 2001").withColumn(
        "l_quantity", F.col("l_quantity") + 100
    )
    layout.replace_partitions(
        redelivered,
        path,
        ["source_year"],
        ["l_returnflag"],
        scope=lambda folder: int(folder["source_year"]) >= 2000,
    )
    return (
        spark.read.parquet(path)
        .groupBy("source_year", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.sum("l_quantity").alias("quantity"))
    )


@registered(
    "src_parquet_pruned",
    """SELECT CAST(EXTRACT(MONTH FROM o_orderdate) AS INTEGER) AS month, o_orderstatus,
       COUNT(*) AS total_rows, MAX(o_totalprice) AS highest
FROM orders WHERE EXTRACT(YEAR FROM o_orderdate) = 1997 GROUP BY 1, 2""",
)
def src_parquet_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by year, read for one year and two columns."""
    path = scratch_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    layout.replace_partitions(orders, path, ["order_year"], ["o_orderdate"])
    return (
        spark.read.parquet(path)
        .where(F.col("order_year") == 1997)
        .groupBy(F.month("o_orderdate").alias("month"), "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.max("o_totalprice").alias("highest"))
    )
