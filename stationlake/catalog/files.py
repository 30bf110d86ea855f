"""Registered queries on files: station CSV, weather JSON, landing checks, and the whole flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.catalog import adapters
from stationlake.catalog.metrics import rounded
from stationlake.catalog.registry import registered, table
from stationlake.functions.cells import to_number
from stationlake.functions.clock import hour_floor
from stationlake.plans import layers, run
from stationlake.plans.inspect import EXPECTED_COLUMNS, column_status
from stationlake.plans.views import register_views
from stationlake.session import scratch_dir, stored
from stationlake.sources import checks, files, station_csv, weather_json
from stationlake.sources.lines import file_lines, text_scan

# ---- station files ------------------------------------------------------------------------------

_PATTERN = "*.txt"

_ODD = "split_part(site, '-', 2)::INTEGER % 2 = 1"
_DATE_TEXT = f"""CASE WHEN {_ODD} THEN strftime(hour, '%-d/%-m/%Y')
            ELSE strftime(hour, '%d-%m-%Y') END"""
_TIME_TEXT = f"""CASE WHEN EXTRACT(HOUR FROM hour) < 23
                 THEN lpad(CAST(EXTRACT(HOUR FROM hour) + 1 AS VARCHAR), 2, '0') || ':00'
            WHEN {_ODD} THEN '24:00' ELSE '24:00:00' END"""


def _cell_sql(event: str) -> str:
    return (
        f"CASE EXTRACT(HOUR FROM hour) WHEN 5 THEN NULL WHEN 13 THEN NULL WHEN 9 THEN -{event} "
        f"ELSE {event} END"
    )


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scan(spark, adapters.raw_zone(spark, sf_dir)[0], _PATTERN)


def _report(spark: SparkSession, sf_dir: str, scan: DataFrame | None = None) -> DataFrame:
    stations, _ = adapters.raw_zone(spark, sf_dir)
    return stored(checks.station_report(spark, stations, _PATTERN, scan=scan), "station-report")


def _station_rows(
    spark: SparkSession, sf_dir: str, report: DataFrame | None = None, scan: DataFrame | None = None
) -> DataFrame:
    stations, _ = adapters.raw_zone(spark, sf_dir)
    scan = _scan(spark, sf_dir) if scan is None else scan
    report = _report(spark, sf_dir, scan) if report is None else report
    lines = file_lines(spark, stations, _PATTERN, scan)
    return station_csv.classified_rows(
        station_csv.read_station_csv(spark, report, stations, _PATTERN, lines=lines)
    )


@registered(
    "src_csv_preamble",
    f"""WITH {adapters.STATION_SQL}
SELECT site, CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year, {_DATE_TEXT} AS date_text,
       {_TIME_TEXT} AS time_text,
       {", ".join(f"{_cell_sql(e)} AS {code.lower()}" for e, code in adapters.EVENT_CODES.items())},
       'R' AS status, 'ugm-3' AS unit_6
FROM station_hours WHERE EXTRACT(HOUR FROM hour) <> 17""",
)
def src_csv_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_csv.data_rows(_station_rows(spark, sf_dir))
    return rows.select(
        "site",
        "source_year",
        F.col(schemas.DATE_COLUMN).alias("date_text"),
        F.col(schemas.TIME_COLUMN).alias("time_text"),
        *[
            to_number(F.col(f"`{adapters.EVENT_MEASURES[e]}`")).alias(code.lower())
            for e, code in adapters.EVENT_CODES.items()
        ],
        "status",
        "unit_6",
    )


@registered(
    "src_csv_malformed",
    f"""WITH {adapters.STATION_SQL}
SELECT {_DATE_TEXT} AS date_text, {_TIME_TEXT} AS time_text, COUNT(*) AS malformed_rows
FROM station_hours WHERE EXTRACT(HOUR FROM hour) = 17 GROUP BY 1, 2""",
)
def src_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = _scan(spark, sf_dir)
    report = _report(spark, sf_dir, scan)
    bad = station_csv.malformed_rows(_station_rows(spark, sf_dir, report, scan), report)
    part = lambda n: F.split_part("line", F.lit(","), F.lit(n))
    return bad.groupBy(part(1).alias("date_text"), part(2).alias("time_text")).agg(
        F.count(F.lit(1)).alias("malformed_rows")
    )


@registered(
    "bronze_lineage",
    f"""WITH {adapters.STATION_SQL}
SELECT 'Main site' AS site_name, site, CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year,
       COUNT(*) AS total_rows, CAST(1 AS BIGINT) AS source_files
FROM station_hours WHERE EXTRACT(HOUR FROM hour) <> 17 GROUP BY 2, 3""",
)
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_csv.data_rows(_station_rows(spark, sf_dir))
    bronze = layers.with_lineage(rows, site_name="Main site")
    return bronze.groupBy("site_name", "site", "source_year").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("source_file").alias("source_files"),
    )


@registered(
    "file_manifest",
    f"""WITH {adapters.STATION_SQL}
SELECT CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year, COUNT(DISTINCT site) AS listed_files,
       CAST(0 AS BIGINT) AS empty_files
FROM station_hours GROUP BY 1""",
)
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations, _ = adapters.raw_zone(spark, sf_dir)
    listing = files.require_files(spark, stations, _PATTERN)
    return listing.groupBy("source_year").agg(
        F.count(F.lit(1)).alias("listed_files"),
        F.count_if(F.col("length") == 0).alias("empty_files"),
    )


@registered(
    "landing_audit",
    f"""WITH {adapters.STATION_SQL}
SELECT site, CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year, COUNT(*) AS row_count,
       CAST(MAX(hour) AS DATE) AS latest_date, CAST(64 AS INTEGER) AS digest_length,
       TRUE AS accepted
FROM station_hours GROUP BY 1, 2""",
)
def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select(
        F.regexp_extract("path", "site=([^/]+)/", 1).alias("site"),
        "source_year",
        "row_count",
        "latest_date",
        F.length("sha256").alias("digest_length"),
        F.col("problem").isNull().alias("accepted"),
    )


def _as_lines(texts: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """The texts of a table as delivered files: kind, uri, at, line."""
    cut = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    lines = texts.select(F.concat(F.lit(f"{kind}-"), key).alias("uri"), cut.alias("lines"))
    parted = lines.select("uri", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line"))
    # A line end at the end of a text starts no further line.
    kept = parted.where((F.col("line") != "") | (F.col("at") < F.col("n") - 1))
    return kept.select("uri", F.col("at").cast("long"), F.rtrim("line", F.lit("\r")).alias("line"))


def _as_files(texts: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    length = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    return texts.select(
        F.concat(F.lit(f"{kind}-"), key).alias("path"),
        F.lit(2024).alias("source_year"),
        length.cast("long").alias("length"),
        F.lit(kind).alias("kind"),
    )


#: What is done to every station file, and what the checks must say of it.
DAMAGES = {
    "as delivered": "none",
    "of another year": "wrong_year",
    "other first line": "preamble",
    "head only": "no_data_rows",
    "measure renamed": "missing_columns",
    "cells lost": "short_row",
    "dates broken": "bad_date",
    "rows blank": "no_valid_rows",
    "very large": "too_large",
}


def _damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Station files as delivered and in eight damaged versions: (listed files, lines); one scan each."""
    stations, _ = adapters.raw_zone(spark, sf_dir)
    kinds = F.explode(F.array(*[F.lit(kind) for kind in DAMAGES])).alias("kind")
    named = lambda column: F.concat(column, F.lit("?"), F.col("kind"))
    kind, line, is_data = F.col("kind"), F.col("line"), F.col("line").rlike(r"^\d")
    version = (
        F.when((kind == "other first line") & line.startswith(schemas.CSV_FIRST_LINE), F.lower(line))
        .when(kind == "measure renamed", F.replace(line, F.lit(",Nitrogen dioxide,"), F.lit(",Nitrogen,")))
        .when((kind == "cells lost") & is_data, F.lit("x"))
        .when((kind == "cells lost") & line.startswith(schemas.DATE_COLUMN), F.concat(F.lit("x,"), line))
        .when((kind == "dates broken") & is_data, F.concat(F.lit("99"), line))
        .when((kind == "rows blank") & is_data, F.lit(",,,"))
        .otherwise(line)
    )
    lines = file_lines(spark, stations, _PATTERN).select("*", kinds).where((kind != "head only") | ~is_data)
    listed = files.file_listing(spark, stations, _PATTERN).select("path", "source_year", "length", kinds)
    later = F.when(kind == "of another year", 1).otherwise(0)
    return (
        listed.select(
            named(F.col("path")).alias("path"),
            (F.col("source_year") + later).alias("source_year"),
            F.when(kind == "very large", F.lit(schemas.CSV_MAX_BYTES + 1)).otherwise(F.col("length")).cast("long").alias("length"),
            "kind",
        ),
        lines.select(named(F.col("uri")).alias("uri"), "at", version.alias("line")),
    )


_STATION_FILES_SQL = "SELECT DISTINCT site, EXTRACT(YEAR FROM hour) AS year FROM station_hours"
_LINES = r"len(string_split_regex(regexp_replace(text, '\r?\n$', ''), '\r?\n'))"
_DAMAGES_SQL = ", ".join(f"('{kind}', '{problem}')" for kind, problem in DAMAGES.items())


@registered(
    "raw_file_checks",
    f"""WITH {adapters.STATION_SQL},
judged AS (
    SELECT 'html' AS kind,
           CASE WHEN length(html) = 0 THEN 'empty'
                WHEN regexp_matches(html, '(?i)\\A\\s*<(!doctype html|html)') THEN 'html'
                ELSE 'no_data_rows' END AS problem FROM pages
    UNION ALL
    SELECT 'text' AS kind,
           CASE WHEN length(text) = 0 THEN 'empty'
                WHEN regexp_matches(text, '(?i)\\A\\s*<(!doctype html|html)') THEN 'html'
                WHEN {_LINES} < 6 THEN 'no_data_rows' ELSE 'preamble' END AS problem FROM documents
    UNION ALL
    SELECT 'no bytes' AS kind, 'empty' AS problem FROM conversations WHERE turn = 0
    UNION ALL
    SELECT kind, problem FROM (VALUES {_DAMAGES_SQL}) AS damages(kind, problem), ({_STATION_FILES_SQL}))
SELECT kind, problem, COUNT(*) AS payloads FROM judged GROUP BY kind, problem""",
)
def raw_file_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, documents, empty files, and every station file as delivered and damaged: all ten problems."""
    pages, documents = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    begun = table(spark, sf_dir, "conversations").where("turn = 0").withColumn("nothing", F.lit(""))
    listed, lines = _damaged(spark, sf_dir)
    listed = (
        listed.unionByName(_as_files(pages, "page_id", "html", "html"))
        .unionByName(_as_files(documents, "doc_id", "text", "text"))
        .unionByName(_as_files(begun, "conv_id", "nothing", "no bytes"))
    )
    lines = lines.unionByName(_as_lines(pages, "page_id", "html", "html")).unionByName(
        _as_lines(documents, "doc_id", "text", "text")
    )
    report = checks.csv_report(listed, lines)
    return report.groupBy("kind", F.coalesce("problem", F.lit("none")).alias("problem")).agg(
        F.count(F.lit(1)).alias("payloads")
    )


_EXPECTED_SQL = ", ".join(f"('{name}')" for name in EXPECTED_COLUMNS)


@registered(
    "raw_columns",
    f"""WITH {adapters.STATION_SQL}
SELECT kind, year::INTEGER AS source_year, column_name,
       CASE WHEN kind = 'other first line' OR kind = 'measure renamed' AND column_name = 'Nitrogen dioxide'
            THEN 'MISSING' ELSE 'OK' END AS status, COUNT(*) AS delivered_files
FROM ({_STATION_FILES_SQL}), (VALUES {_EXPECTED_SQL}) AS expected(column_name),
     (VALUES ('as delivered'), ('measure renamed'), ('other first line')) AS kinds(kind)
GROUP BY ALL""",
)
def raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which expected columns the headers of the raw files hold."""
    listed, lines = _damaged(spark, sf_dir)
    kinds = F.col("kind").isin("as delivered", "measure renamed", "other first line")
    report = checks.csv_report(listed.where(kinds), lines)
    status = column_status(report.withColumn("path", F.col("kind")))
    return status.groupBy(F.col("path").alias("kind"), "source_year", "column_name", "status").agg(
        F.count(F.lit(1)).alias("delivered_files")
    )


# ---- weather documents --------------------------------------------------------------------------

_CALENDAR_SQL = """
hours AS (
    SELECT date_trunc('hour', ts) AS hour, MAX(value) AS highest, MIN(value) AS lowest,
           COUNT(value) AS n
    FROM events GROUP BY 1),
calendar AS (
    SELECT unnest(generate_series(MIN(hour), MAX(hour), INTERVAL 1 HOUR)) AS hour FROM hours)"""


@registered(
    "src_json_arrays",
    f"""WITH {_CALENDAR_SQL}
SELECT hour AS recorded_at, 'Main city' AS city, COALESCE(highest, 0) / 20 AS temperature_2m,
       COALESCE(lowest, 0) AS relative_humidity_2m, CAST(COALESCE(n, 0) AS DOUBLE) AS precipitation,
       COALESCE(highest, 0) + 1000 AS pressure_msl, COALESCE(lowest, 0) / 2 AS wind_speed_10m,
       CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS year,
       CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year
FROM calendar LEFT JOIN hours USING (hour)""",
)
def src_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, weather = adapters.raw_zone(spark, sf_dir)
    documents = weather_json.read_weather_documents(spark, weather)
    bronze = layers.with_lineage(
        weather_json.flatten_documents(documents), city="Main city", source_name="archive"
    )
    return layers.silver_weather(bronze).drop("source_name", "source_file")


def _daily_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per day and event type. Events are reduced to hours before they are collected,
    so an array has at most 24 entries."""
    hour = hour_floor(F.col("ts"))
    hours = (
        table(spark, sf_dir, "events")
        .groupBy(hour.alias("hour"), "event_type")
        .agg(
            F.max("value").alias("temperature_2m"),
            F.min("value").alias("relative_humidity_2m"),
            F.count("value").cast("double").alias("precipitation"),
            F.max("user_id").cast("double").alias("pressure_msl"),
            F.min("user_id").cast("double").alias("wind_speed_10m"),
        )
    )
    entry = F.struct(
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), *schemas.WEATHER_MEASURES
    )
    days = hours.groupBy(F.col("hour").cast("date").alias("day"), "event_type").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    arrays = [F.col(f"entries.{name}").alias(name) for name in schemas.WEATHER_ARRAYS]
    return days.select(
        "day", "event_type", F.year("day").alias("source_year"), F.struct(*arrays).alias("hourly")
    )


_HOURS_BY_TYPE_SQL = """
hours AS (
    SELECT date_trunc('hour', ts) AS hour, event_type, MAX(value) AS temperature_2m,
           MIN(value) AS relative_humidity_2m, CAST(COUNT(value) AS DOUBLE) AS precipitation,
           CAST(MAX(user_id) AS DOUBLE) AS pressure_msl, CAST(MIN(user_id) AS DOUBLE) AS wind_speed_10m
    FROM events GROUP BY 1, 2)"""


@registered(
    "json_flatten",
    f"""WITH {_HOURS_BY_TYPE_SQL}
SELECT CAST(hour AS DATE) AS day, event_type, hour AS recorded_at, temperature_2m,
       relative_humidity_2m, precipitation, pressure_msl, wind_speed_10m,
       CAST(EXTRACT(YEAR FROM hour) AS INTEGER) AS source_year
FROM hours""",
)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = weather_json.flatten_documents(_daily_documents(spark, sf_dir))
    return flat.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@registered(
    "json_array_checks",
    f"""WITH {_HOURS_BY_TYPE_SQL}
SELECT CAST(hour AS DATE) AS day, event_type,
       CASE event_type WHEN 'click' THEN 'no_hourly' WHEN 'error' THEN 'missing_fields'
                       WHEN 'purchase' THEN 'length_mismatch' WHEN 'signup' THEN 'starts_in_other_year'
                       ELSE 'none' END AS problem,
       CASE event_type WHEN 'click' THEN NULL ELSE COUNT(*) END AS row_count,
       CASE event_type WHEN 'click' THEN NULL
                       ELSE strftime(MAX(hour), '%Y-%m-%dT%H:%M') END AS latest_timestamp
FROM hours GROUP BY 1, 2""",
)
def json_array_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type but ``view`` gets one kind of damage."""
    kind, hourly = F.col("event_type"), F.col("hourly")
    damaged = (
        _daily_documents(spark, sf_dir)
        .withColumn(
            "hourly",
            F.when(kind == "click", F.lit(None))
            .when(
                kind == "error",
                hourly.withField("pressure_msl", F.lit(None).cast("array<double>")),
            )
            .when(
                kind == "purchase",
                hourly.withField(
                    "precipitation", F.array_append("hourly.precipitation", F.lit(0.0))
                ),
            )
            .otherwise(hourly),
        )
        .withColumn(
            "source_year",
            F.when(kind == "signup", F.col("source_year") + 1).otherwise(F.col("source_year")),
        )
    )
    return checks.weather_problems(damaged).select(
        "day",
        "event_type",
        F.coalesce("problem", F.lit("none")).alias("problem"),
        "row_count",
        "latest_timestamp",
    )


# ---- the whole flow -------------------------------------------------------------------------------

_PIVOT_BACK = " UNION ALL ".join(
    [
        f"SELECT site, hour, '{code}' AS pollutant, {event} AS delivered FROM station_hours"
        for event, code in adapters.EVENT_CODES.items()
    ]
    + [
        f"SELECT site, hour, '{code}' AS pollutant, CAST(NULL AS DOUBLE) AS delivered FROM station_hours"
        for code in schemas.MEASURES.values()
        if code not in adapters.EVENT_CODES.values()
    ]
)


@registered(
    "medallion_end_to_end",
    f"""WITH {adapters.STATION_SQL},
delivered AS ({_PIVOT_BACK}),
silver AS (
    SELECT hour + INTERVAL 1 HOUR AS recorded_at, site AS site_name, pollutant,
           CASE WHEN EXTRACT(HOUR FROM hour) IN (5, 9, 13) THEN NULL ELSE delivered END AS value
    FROM delivered WHERE EXTRACT(HOUR FROM hour) <> 17),
delivered_days AS (
    SELECT recorded_at::DATE AS reading_date, site_name, pollutant, COUNT(*) AS n FROM silver GROUP BY ALL),
good_days AS (
    SELECT recorded_at::DATE AS reading_date, site_name, pollutant, COUNT(*) AS good, AVG(value) AS mean,
           MIN(value) AS low, MAX(value) AS high FROM silver WHERE value IS NOT NULL GROUP BY ALL)
SELECT reading_date, site_name, pollutant, ROUND(mean, 6) AS avg_value, low AS min_value, high AS max_value,
       COALESCE(good, 0)::INTEGER AS valid_readings, n::INTEGER AS expected_readings,
       (n - COALESCE(good, 0))::INTEGER AS missing_readings,
       ROUND(100.0 * COALESCE(good, 0) / n, 2) AS completeness_pct,
       year(reading_date)::INTEGER AS year, month(reading_date)::INTEGER AS month
FROM delivered_days LEFT JOIN good_days USING (reading_date, site_name, pollutant)""",
)
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to the published daily table, through the gate and the keyed publish."""
    stations, weather = adapters.raw_zone(spark, sf_dir)
    lake = run.Lake(
        stations, weather, scratch_dir(spark, "lake"), readings_pattern=_PATTERN
    )
    run.run(spark, lake)
    return rounded(run.served(spark, lake, "daily_readings"), "avg_value")


def _built_lake(spark: SparkSession, sf_dir: str) -> run.Lake:
    """A lake run once per session, for queries that only look at its tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        stations, weather = adapters.raw_zone(spark, sf_dir)
        lake = run.Lake(stations, weather, scratch_dir(spark, "lake"), readings_pattern=_PATTERN)
        run.run(spark, lake)
        _LAKES[key] = lake
    return _LAKES[key]


_LAKES: dict[tuple[str, str], run.Lake] = {}

_SILVER_SQL = f"""{adapters.STATION_SQL},
delivered AS ({_PIVOT_BACK}),
silver AS (
    SELECT hour + INTERVAL 1 HOUR AS recorded_at, site AS site_name, pollutant, year(hour)::INTEGER AS source_year,
           CASE WHEN EXTRACT(HOUR FROM hour) IN (5, 9, 13) THEN NULL ELSE delivered END AS value
    FROM delivered WHERE EXTRACT(HOUR FROM hour) <> 17)"""


@registered(
    "medallion_hourly",
    f"""WITH {_SILVER_SQL}, {_CALENDAR_SQL}
SELECT s.recorded_at, s.recorded_at::DATE AS reading_date, site_name, pollutant, value AS pollutant_value,
       'ugm-3' AS pollutant_unit, CASE WHEN c.hour IS NOT NULL THEN 'Main city' END AS city,
       CASE WHEN c.hour IS NOT NULL THEN coalesce(highest, 0) / 20 END AS temperature_2m,
       CASE WHEN c.hour IS NOT NULL THEN coalesce(n, 0)::DOUBLE END AS precipitation,
       year(s.recorded_at)::INTEGER AS year, month(s.recorded_at)::INTEGER AS month
FROM silver s LEFT JOIN calendar c ON c.hour = s.recorded_at LEFT JOIN hours h ON h.hour = c.hour""",
)
def medallion_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published hourly table of the whole flow."""
    rows = run.served(spark, _built_lake(spark, sf_dir), "hourly_environment")
    rows = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    return rows.drop("relative_humidity_2m", "pressure_msl", "wind_speed_10m")


@registered(
    "medallion_weather",
    f"""WITH {_CALENDAR_SQL},
filled AS (
    SELECT calendar.hour, coalesce(highest, 0) / 20 AS warmth, coalesce(n, 0)::DOUBLE AS rain
    FROM calendar LEFT JOIN hours ON hours.hour = calendar.hour)
SELECT hour::DATE AS reading_date, 'Main city' AS city, round(sum(warmth), 5) AS warmth,
       min(warmth) AS min_temperature_2m, max(warmth) AS max_temperature_2m, sum(rain) AS total_precipitation,
       count(*)::INTEGER AS expected_readings, year(hour::DATE)::INTEGER AS year
FROM filled GROUP BY hour::DATE""",
)
def medallion_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published daily weather of the whole flow."""
    rows = run.served(spark, _built_lake(spark, sf_dir), "daily_weather")
    return rows.select(
        "reading_date",
        "city",
        F.round(F.col("avg_temperature_2m") * F.col("expected_readings"), 5).alias("warmth"),
        "min_temperature_2m",
        "max_temperature_2m",
        "total_precipitation",
        "expected_readings",
        "year",
    )


@registered(
    "lake_sql",
    f"""WITH {_SILVER_SQL}, {_CALENDAR_SQL}
SELECT pollutant, count(*) AS silver_rows, count(value) AS valid_rows, count(c.hour) AS with_weather,
       (SELECT count(*) FROM station_hours WHERE EXTRACT(HOUR FROM hour) = 17) AS malformed_lines
FROM silver s LEFT JOIN calendar c ON c.hour = s.recorded_at GROUP BY pollutant""",
)
def lake_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in SQL over the views of a lake, across layers."""
    register_views(spark, _built_lake(spark, sf_dir))
    return spark.sql("""
        WITH silver AS (
            SELECT pollutant, count(*) AS silver_rows, count(value) AS valid_rows FROM silver_readings GROUP BY pollutant),
        hourly AS (
            SELECT pollutant, count(city) AS with_weather FROM serving_hourly_environment GROUP BY pollutant)
        SELECT pollutant, silver_rows, valid_rows, with_weather, malformed_lines
        FROM silver JOIN hourly USING (pollutant) CROSS JOIN (SELECT count(*) AS malformed_lines FROM bronze_malformed)
    """)


@registered(
    "written_counts",
    f"""WITH {_SILVER_SQL}
SELECT source_year, count(*) AS dated_rows FROM silver GROUP BY source_year""",
)
def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the silver write counted by file year and the gate relies on; no layer is read for it."""
    lake = _built_lake(spark, sf_dir)
    return spark.read.schema("dated_rows long, source_year int").parquet(lake.path("counts", "readings"))
