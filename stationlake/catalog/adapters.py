"""The given tables seen as station data, in Spark and as SQL common table expressions.

Every adapter keeps all rows of its table. Where cells are made dirty, the rule looks at the time of
the event, so the share of dirty cells is the same at every size.
Odd divisors keep averages away from decimal ties, where two engines may round differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.catalog.registry import table
from stationlake.functions.clock import hour_floor
from stationlake.operators.cleaning import clean_readings
from stationlake.session import scratch_dir

# ---- long readings from events ----------------------------------------------------------------


def site(user: Column) -> Column:
    return F.concat(F.lit("site-"), (user % 4).cast("string"))


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event, its value as delivered text with blank, bad and negative cells."""
    minute = F.minute("ts")
    value = F.col("value") / 7  # readings with all the digits of a double
    cell = (
        F.when(minute < 3, F.lit(None).cast("string"))
        .when(minute < 5, F.lit("bad-value"))
        .when(minute < 8, (-value).cast("string"))
        .when(minute < 9, F.lit("NA"))
        .otherwise(value.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        hour_floor(F.col("ts")).alias("recorded_at"),
        site(F.col("user_id")).alias("site_name"),
        F.col("event_type").alias("pollutant"),
        cell.alias("cell"),
        "event_id",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text_readings`` after cleaning."""
    return clean_readings(text_readings(spark, sf_dir))


READINGS_SQL = """
text_readings AS (
    SELECT date_trunc('hour', ts) AS recorded_at,
           'site-' || CAST(user_id % 4 AS VARCHAR) AS site_name,
           event_type AS pollutant,
           CASE WHEN EXTRACT(MINUTE FROM ts) < 3 THEN NULL
                WHEN EXTRACT(MINUTE FROM ts) < 5 THEN 'bad-value'
                WHEN EXTRACT(MINUTE FROM ts) < 8 THEN CAST(-(value / 7) AS VARCHAR)
                WHEN EXTRACT(MINUTE FROM ts) < 9 THEN 'NA'
                ELSE CAST(value / 7 AS VARCHAR) END AS cell,
           event_id
    FROM events),
readings AS (
    SELECT recorded_at, site_name, pollutant, if(number >= 0, number, NULL) AS value, event_id
    FROM (SELECT *, TRY_CAST(cell AS DOUBLE) AS number FROM text_readings))"""

DAILY_SQL = (
    READINGS_SQL
    + """,
daily AS (
    WITH delivered AS (
        SELECT recorded_at::DATE AS reading_date, site_name, pollutant, COUNT(*) AS rows_of_day
        FROM readings GROUP BY ALL),
    good AS (
        SELECT recorded_at::DATE AS reading_date, site_name, pollutant, COUNT(*) AS good_rows,
               SUM(value) / COUNT(*) AS mean, MIN(value) AS low, MAX(value) AS high
        FROM readings WHERE value IS NOT NULL GROUP BY ALL),
    both_sides AS (
        SELECT delivered.*, COALESCE(good_rows, 0) AS good_rows, mean, low, high
        FROM delivered LEFT JOIN good USING (reading_date, site_name, pollutant))
    SELECT reading_date, site_name, pollutant, mean AS avg_value, low AS min_value, high AS max_value,
           good_rows AS valid_readings, rows_of_day AS expected_readings,
           rows_of_day - good_rows AS missing_readings,
           ROUND(100.0 * good_rows / rows_of_day, 2) AS completeness_pct,
           year(reading_date)::INTEGER AS year, month(reading_date)::INTEGER AS month
    FROM both_sides)"""
)

# ---- weather from orders ----------------------------------------------------------------------


def order_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per order; the order status stands for the city."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("recorded_at"),
        F.col("o_orderstatus").alias("city"),
        F.when(F.col("o_orderpriority") != "5-LOW", price / 20011).alias("temperature_2m"),
        (F.col("o_custkey") % 100).cast("double").alias("relative_humidity_2m"),
        (price / 1009).alias("precipitation"),
        (price / 503).alias("pressure_msl"),
        (price / 40009).alias("wind_speed_10m"),
    )


ORDER_WEATHER_SQL = """
order_weather AS (
    SELECT o_orderdate AS recorded_at, o_orderstatus AS city,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 20011 END AS temperature_2m,
           CAST(o_custkey % 100 AS DOUBLE) AS relative_humidity_2m,
           o_totalprice / 1009 AS precipitation, o_totalprice / 503 AS pressure_msl,
           o_totalprice / 40009 AS wind_speed_10m
    FROM orders)"""

DAILY_WEATHER_SQL = (
    ORDER_WEATHER_SQL
    + """,
daily_weather AS (
    WITH delivered AS (
        SELECT recorded_at, city, COUNT(*) AS rows_of_day, AVG(relative_humidity_2m) AS humidity,
               SUM(precipitation) AS rain, AVG(pressure_msl) AS pressure, AVG(wind_speed_10m) AS wind
        FROM order_weather GROUP BY ALL),
    warm AS (
        SELECT recorded_at, city, COUNT(*) AS good_rows, AVG(temperature_2m) AS mean,
               MIN(temperature_2m) AS low, MAX(temperature_2m) AS high
        FROM order_weather WHERE temperature_2m IS NOT NULL GROUP BY ALL),
    both_sides AS (
        SELECT delivered.*, COALESCE(good_rows, 0) AS good_rows, mean, low, high
        FROM delivered LEFT JOIN warm USING (recorded_at, city))
    SELECT recorded_at::DATE AS reading_date, city, mean AS avg_temperature_2m,
           low AS min_temperature_2m, high AS max_temperature_2m, humidity AS avg_relative_humidity_2m,
           rain AS total_precipitation, pressure AS avg_pressure_msl, wind AS avg_wind_speed_10m,
           good_rows AS valid_temperature_readings, rows_of_day AS expected_readings,
           rows_of_day - good_rows AS missing_temperature_readings,
           ROUND(100.0 * good_rows / rows_of_day, 2) AS temperature_completeness_pct,
           year(recorded_at)::INTEGER AS year, month(recorded_at)::INTEGER AS month
    FROM both_sides)"""
)

# ---- long readings from lineitem, weather unique per order date ---------------------------------


def shipped_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per line item on its ship date; the supplier stands for the site."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("recorded_at"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("site_name"),
        F.col("l_returnflag").alias("pollutant"),
        F.col("l_quantity").alias("value"),
        F.lit(schemas.MEASURE_UNIT).alias("unit"),
    )


def _weather_of(price: str, customer: str) -> list[Column]:
    highest = F.max(price)
    return [
        (highest / 20011).alias("temperature_2m"),
        F.max(customer).cast("double").alias("relative_humidity_2m"),
        F.min(price).alias("precipitation"),
        highest.alias("pressure_msl"),
        F.count(F.lit(1)).cast("double").alias("wind_speed_10m"),
    ]


def weather_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").alias("recorded_at"))
        .agg(*_weather_of("o_totalprice", "o_custkey"))
        .withColumn("city", F.lit("Main city"))
    )


def weather_per_date_and_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("o_orderdate").alias("recorded_at"), "city")
        .agg(*_weather_of("o_totalprice", "o_custkey"))
    )


def site_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("site_name"),
            "city",
        )
    )


_WEATHER_OF_SQL = """MAX(o_totalprice) / 20011 AS temperature_2m,
           CAST(MAX(o_custkey) AS DOUBLE) AS relative_humidity_2m, MIN(o_totalprice) AS precipitation,
           MAX(o_totalprice) AS pressure_msl, CAST(COUNT(*) AS DOUBLE) AS wind_speed_10m"""

SHIPPED_SQL = f"""
shipped AS (
    SELECT l_shipdate AS recorded_at, 'supplier-' || CAST(l_suppkey AS VARCHAR) AS site_name,
           l_returnflag AS pollutant, l_quantity AS value, 'ugm-3' AS unit
    FROM lineitem),
weather AS (
    SELECT o_orderdate AS recorded_at, 'Main city' AS city, {_WEATHER_OF_SQL}
    FROM orders GROUP BY o_orderdate),
nation_weather AS (
    SELECT o_orderdate AS recorded_at, n_name AS city, {_WEATHER_OF_SQL}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY o_orderdate, n_name),
site_nations AS (
    SELECT 'supplier-' || CAST(s_suppkey AS VARCHAR) AS site_name, n_name AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

HOURLY_COLUMNS_SQL = """r.* RENAME (value AS pollutant_value, unit AS pollutant_unit), w.* EXCLUDE (recorded_at),
       r.recorded_at::DATE AS reading_date, year(r.recorded_at)::INTEGER AS year,
       month(r.recorded_at)::INTEGER AS month"""

# ---- raw zone: station files and weather documents written from events --------------------------

# Event type -> raw measure column. The other measure columns of the files stay blank.
EVENT_MEASURES = {
    "click": "Nitrogen dioxide",
    "error": "Nitrogen oxides as nitrogen dioxide",
    "purchase": "PM<sub>10</sub> particulate matter (Hourly measured)",
    "signup": "Nitric oxide",
    "view": "Ozone",
}
EVENT_CODES = {event: schemas.MEASURES[raw] for event, raw in EVENT_MEASURES.items()}

# The lines above the header of a delivered file.
_PREAMBLE = (
    f"{schemas.CSV_FIRST_LINE} on 31/7/2026",
    "All Data GMT hour ending",
    "Status: R =Ratified P=Provisional,P*=As supplied",
    ",,Station,,",
)


def station(user: Column) -> Column:
    """Seven users share a station of the raw zone, so stations and files grow with the table."""
    return F.concat(F.lit("site-"), F.floor(user / 7).cast("string"))


def station_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per station and hour: the highest value of each event type. Sums up before any shuffle."""
    highest = [
        F.max(F.when(F.col("event_type") == e, F.col("value"))).alias(e) for e in EVENT_MEASURES
    ]
    return (
        table(spark, sf_dir, "events")
        .groupBy(station(F.col("user_id")).alias("site"), hour_floor(F.col("ts")).alias("hour"))
        .agg(*highest)
    )


def _cell(event: str) -> Column:
    hour, value = F.hour("hour"), F.col(event)
    return F.coalesce(
        F.when(hour == 5, F.lit("N/A"))
        .when(hour == 9, (-value).cast("string"))
        .when(hour == 13, F.lit("bad-value"))
        .otherwise(value.cast("string")),
        F.lit(""),
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the station files: source_year, site, position, line.

    Stations with an odd number have another column order, date format and midnight spelling. The
    row of hour 17 has a cell too many. Readings are stamped with the end of their hour.
    """
    cells = {raw: F.lit("") for raw in schemas.MEASURES}
    cells.update({raw: _cell(event) for event, raw in EVENT_MEASURES.items()})
    orders = {0: list(schemas.MEASURES), 1: list(reversed(schemas.MEASURES))}
    odd = F.substring_index("site", "-", -1).cast("int") % 2 == 1
    hour = F.hour("hour")
    midnight = F.when(odd, "24:00").otherwise("24:00:00")
    clock = F.when(hour == 23, midnight).otherwise(F.format_string("%02d:00", hour + 1))
    day = F.when(odd, F.date_format("hour", "d/M/yyyy")).otherwise(
        F.date_format("hour", "dd-MM-yyyy")
    )

    def body(order: list[str]) -> Column:
        triples = [F.concat(cells[raw], F.lit(f",R,{schemas.MEASURE_UNIT}")) for raw in order]
        return F.concat_ws(",", day, clock, *triples)

    def header(order: list[str]) -> str:
        return ",".join(["Date,time", *[f"{raw},status,unit" for raw in order]])

    hours = station_hours(spark, sf_dir).withColumn("source_year", F.year("hour"))
    line = F.when(odd, body(orders[1])).otherwise(body(orders[0]))
    data = hours.select(
        "source_year",
        "site",
        (F.datediff("hour", F.lit("1970-01-01").cast("date")) * 24 + hour).alias("position"),
        F.concat(line, F.when(hour == 17, F.lit(",surplus")).otherwise(F.lit(""))).alias("line"),
    )
    titles = [
        F.struct(F.lit(i - 9).alias("position"), F.lit(text).alias("line"))
        for i, text in enumerate(_PREAMBLE)
    ]
    head = F.when(odd, F.lit(header(orders[1]))).otherwise(F.lit(header(orders[0])))
    titles.append(F.struct(F.lit(-1).alias("position"), head.alias("line")))
    tops = hours.select("source_year", "site").distinct().select(
        "source_year", "site", F.inline(F.array(*titles))
    )
    return data.unionByName(tops)


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per year with an entry for every hour between the first and the last event.

    The arrays hold at most the hours of a year; events are reduced to hours first.
    """
    hour = hour_floor(F.col("ts"))
    events = table(spark, sf_dir, "events")
    span = events.agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    one_hour = F.expr("INTERVAL 1 HOUR")
    calendar = span.select(F.explode(F.sequence("first", "last", one_hour)).alias("hour"))
    measured = events.groupBy(hour.alias("hour")).agg(
        F.max("value").alias("highest"), F.min("value").alias("lowest"), F.count("value").alias("n")
    )
    highest = F.coalesce("highest", F.lit(0.0))
    lowest = F.coalesce("lowest", F.lit(0.0))
    entry = F.struct(
        "hour",
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (highest / 20).alias("temperature_2m"),
        lowest.alias("relative_humidity_2m"),
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("precipitation"),
        (highest + 1000).alias("pressure_msl"),
        (lowest / 2).alias("wind_speed_10m"),
    )
    years = (
        calendar.join(measured, "hour", "left")
        .groupBy(F.year("hour").alias("source_year"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    arrays = [F.col(f"entries.{name}").alias(name) for name in schemas.WEATHER_ARRAYS]
    return years.select(
        "source_year", F.lit(0.25).alias(schemas.VOLATILE_JSON_KEY), F.struct(*arrays).alias("hourly")
    )


_WRITTEN: dict[tuple[str, str, str], str] = {}


def raw_zone(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(folder of station files, folder of weather documents), written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "raw")
    if key not in _WRITTEN:
        root = scratch_dir(spark, "raw")
        by = ["source_year", "site"]
        (
            station_lines(spark, sf_dir)
            .repartition(*by)
            .sortWithinPartitions(*by, "position")
            .select(*by, "line")
            .write.partitionBy(*by)
            .text(f"{root}/stations")
        )
        (
            weather_documents(spark, sf_dir)
            .repartition("source_year")
            .write.partitionBy("source_year")
            .json(f"{root}/weather")
        )
        _WRITTEN[key] = root
    root = _WRITTEN[key]
    return f"{root}/stations", f"{root}/weather"


_event_cells = ",\n           ".join(
    f"MAX(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in EVENT_MEASURES
)
STATION_SQL = f"""
station_hours AS (
    SELECT 'site-' || CAST(user_id // 7 AS VARCHAR) AS site, date_trunc('hour', ts) AS hour,
           {_event_cells}
    FROM events GROUP BY 1, 2)"""
