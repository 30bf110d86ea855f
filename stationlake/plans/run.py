"""The whole flow: raw files to published tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.errors import MissingInputError, RawFileRejected
from stationlake.operators import daily, expect, layout, serving
from stationlake.plans import layers
from stationlake.session import path_exists
from stationlake.sources import checks, files, landing, station_csv, weather_json
from stationlake.sources.lines import file_lines, text_scan


@dataclass(frozen=True)
class Lake:
    """Folders and labels of one lake. ``raw_readings`` and ``raw_weather`` hold ``year=Y`` or
    ``source_year=Y`` (and, for several sites, ``site=S``) folders. Files above the byte limits are
    rejected, as any other file that fails a check."""

    raw_readings: str
    raw_weather: str
    root: str
    site_name: str = "Main site"
    city: str = "Main city"
    weather_source: str = "weather archive"
    readings_pattern: str = "*.csv"
    weather_pattern: str = "*.json"
    readings_max_bytes: int = schemas.CSV_MAX_BYTES
    weather_max_bytes: int = schemas.JSON_MAX_BYTES

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def _together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent steps from several threads, so their Spark jobs share the executors. The
    first error is raised once all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in started]


#: What a bronze step returns for a source that has no folder of the years asked for.
NOT_BEGUN: dict = {"rows": 0}


def _landing_report(
    spark: SparkSession, lake: Lake, table: str, report: DataFrame
) -> DataFrame:
    """Store the per-file report of this delivery and return it; raise when a file is rejected.

    The report is pending until ``accept_delivery``: what was
    landed before stays the state that the next delivery is compared with.
    """
    delivered = lake.path("landing", f"{table}_delivered")
    report.withColumn("source", F.lit(table)).write.mode("overwrite").parquet(delivered)
    report = spark.read.parquet(delivered)
    bad = report.where("problem IS NOT NULL")
    first = bad.orderBy("path").select("path", "problem").first()
    if first:
        raise RawFileRejected(
            f"{table}: {bad.count()} files rejected, listed in {delivered}; "
            f"the first is {first['path']}: {first['problem']}"
        )
    return report


def accept_delivery(
    spark: SparkSession, lake: Lake, table: str, landed_at: str | None = None
) -> None:
    """Make the pending report of ``table`` the landed state of its years, after they are published.

    ``landed_at`` (text, given by the caller: nothing here reads the clock) is kept with each file. A
    file that landed with the same digest before keeps its record.
    """
    delivered = lake.path("landing", f"{table}_delivered")
    if not path_exists(spark, delivered):
        return
    report = spark.read.parquet(delivered)
    report = report.withColumn("landed_at", F.lit(landed_at).cast("string"))
    stored = lake.path("landing", table)
    years = set(_years(report))
    if path_exists(spark, stored):
        old = spark.read.parquet(stored).select("path", "sha256", F.col("landed_at").alias("since"))
        report = report.join(old, ["path", "sha256"], "left").withColumn(
            "landed_at", F.coalesce("since", "landed_at")
        ).drop("since")
        # The rows are needed after the partitions they come from have been replaced.
        pending = lake.path("landing", f"{table}_accepted")
        report.write.mode("overwrite").parquet(pending)
        report = spark.read.parquet(pending)
    layout.replace_partitions(
        report, stored, ["source_year"], scope=lambda folder: _year(folder) in years
    )


def _year(folder: dict[str, str]) -> int | None:
    value = folder.get("source_year", folder.get("year", ""))
    return int(value) if value.isdigit() else None


def changed_years(
    spark: SparkSession,
    lake: Lake,
    as_of_year: int,
    table: str = "readings",
    latest_year: int | None = None,
) -> list[int]:
    """File years whose content differs from what was published before, oldest first.

    Old files of unchanged size are not opened. The others are compared by SHA-256 alone; their rows
    are not taken apart. With ``latest_year``, landed years older than the refresh window are frozen.
    """
    raw, pattern, digests = {
        "readings": (lake.raw_readings, lake.readings_pattern, checks.listed_with_digests),
        "weather": (lake.raw_weather, lake.weather_pattern, checks.weather_digests),
    }[table]
    listing = files.require_files(spark, raw, pattern)
    stored = lake.path("landing", table)
    if path_exists(spark, stored):
        landed = spark.read.parquet(stored).select("path", "length", "sha256")
    else:
        landed = spark.createDataFrame([], "path string, length bigint, sha256 string")
    plan = landing.sync_plan(listing, landed, as_of_year)
    years = _years(plan.where(F.col("action") == "fetch"))
    if not years:
        return []
    delivered = digests(spark, files.year_folders(spark, raw, years), pattern)
    status = landing.landing_plan(delivered, landed, latest_year)
    return _years(status.where(F.col("status") == "uploaded"))


def _years(files_frame: DataFrame) -> list[int]:
    rows = files_frame.select("source_year").distinct().collect()  # one row per file year
    return sorted(r["source_year"] for r in rows)


def build_bronze_readings(
    spark: SparkSession, lake: Lake, years: Sequence[int] | None = None
) -> dict:
    """Validate and read the station files; replace the bronze partitions of their years.

    The per-file report decides on acceptance and tells the reader the layout of each file.
    """
    pattern = lake.readings_pattern
    listing = files.require_files(spark, lake.raw_readings, pattern)
    folders = files.year_folders(spark, lake.raw_readings, years)
    if not folders:
        return NOT_BEGUN
    # Station files are many: their folders are listed once for the checks and once for all scans.
    scan = text_scan(spark, folders, pattern)
    report = _landing_report(
        spark,
        lake,
        "readings",
        checks.station_report(
            spark, folders, pattern, lake.readings_max_bytes, listing if years is None else None, scan
        ),
    )
    lines = file_lines(spark, folders, pattern, scan)
    rows = station_csv.classified_rows(
        station_csv.read_station_csv(spark, report, folders, pattern, lines=lines)
    )
    rows = rows.withColumn("site_name", F.coalesce("site", F.lit(lake.site_name))).drop("site")
    return layout.replace_partitions(
        rows,
        lake.path("bronze", "readings"),
        ["kind", "source_year"],
        counts={"rows": F.count_if(F.col("kind") == "data")},
        scope=_in_years(years),
    )


def _folders(
    spark: SparkSession, root: str, pattern: str, years: Sequence[int] | None
) -> list[str]:
    """The folders to read; none if the source has not begun the years asked for."""
    files.require_files(spark, root, pattern)
    return files.year_folders(spark, root, years)


def _in_years(years: Sequence[int] | None) -> Callable[[dict[str, str]], bool]:
    return lambda folder: years is None or _year(folder) in years


def bronze_readings(spark: SparkSession, lake: Lake) -> DataFrame:
    """The well-formed bronze rows."""
    return station_csv.data_rows(spark.read.parquet(lake.path("bronze", "readings")))


def malformed_lines(spark: SparkSession, lake: Lake) -> DataFrame:
    """The lines that bronze set aside: path, source_file, line."""
    reports = [
        spark.read.parquet(path).select("path", "preamble")
        for path in (lake.path("landing", "readings"), lake.path("landing", "readings_delivered"))
        if path_exists(spark, path)
    ]
    if not reports:
        raise MissingInputError(f"no landing report below {lake.root}")
    return station_csv.malformed_rows(
        spark.read.parquet(lake.path("bronze", "readings")), reduce(DataFrame.unionByName, reports)
    )


def build_bronze_weather(
    spark: SparkSession, lake: Lake, years: Sequence[int] | None = None
) -> dict:
    """Check and flatten the weather documents; replace the bronze partitions of their years."""
    folders = _folders(spark, lake.raw_weather, lake.weather_pattern, years)
    if not folders:
        return NOT_BEGUN
    landed = files.payloads(spark, folders, lake.weather_pattern)
    # The arrays must be checked before they are zipped into rows.
    _landing_report(spark, lake, "weather", checks.weather_report(landed, lake.weather_max_bytes))
    documents = weather_json.read_weather_documents(
        spark, lake.raw_weather, lake.weather_pattern, folders
    )
    rows = layers.with_lineage(
        weather_json.flatten_documents(documents),
        city=lake.city,
        source_name=lake.weather_source,
    )
    return layout.replace_partitions(
        rows,
        lake.path("bronze", "weather"),
        ["source_year"],
        counts={"rows": F.count(F.lit(1))},
        scope=_in_years(years),
    )


def _require(spark: SparkSession, lake: Lake, layer: str, *names: str) -> None:
    """``MissingInputError`` unless the tables of a layer are there."""
    for name in names:
        if not path_exists(spark, lake.path(layer, name)):
            raise MissingInputError(f"no {layer} table {name} below {lake.root}; build it first")


def build_silver(
    spark: SparkSession, lake: Lake, strict: bool = True, years: Sequence[int] | None = None
) -> dict:
    """Bronze to silver; each bronze partition becomes the silver partition of the same name."""
    _require(spark, lake, "bronze", "readings", "weather")
    bronze = bronze_readings(spark, lake)
    weather = spark.read.parquet(lake.path("bronze", "weather"))
    if years is not None:
        bronze = bronze.where(F.col("source_year").isin(*years))
        weather = weather.where(F.col("source_year").isin(*years))
    file_years = sorted({_year({"source_year": y}) for y in _bronze_years(spark, lake)} - {None})
    if years is not None:
        file_years = [y for y in file_years if y in years]
    readings_counts, weather_counts = _together(
        spark,
        partial(
            layout.replace_partitions,
            layers.silver_readings(bronze, strict=strict),
            lake.path("silver", "readings"),
            ["source_year"],
            counts={"rows": F.count(F.lit(1)), "valid": F.count("value"), **_by_year(file_years)},
            scope=_in_years(years),
        ),
        partial(
            layout.replace_partitions,
            layers.silver_weather(weather),
            lake.path("silver", "weather"),
            ["source_year"],
            counts={"rows": F.count(F.lit(1))},
            scope=_in_years(years),
        ),
    )
    dated = {y: readings_counts.pop(f"dated_{y}") for y in file_years}
    carried = spark.createDataFrame(list(dated.items()), "source_year int, dated_rows long")
    layout.replace_partitions(
        carried, lake.path("counts", "readings"), ["source_year"], whole_table=years is None, scope=_in_years(years)
    )
    return {"readings": readings_counts, "weather": weather_counts}


def _bronze_years(spark: SparkSession, lake: Lake) -> set[str]:
    """The file years of the bronze readings, by the names of their folders."""
    folders = layout.partition_folders(spark, lake.path("bronze", "readings"), 2)
    return {f.split("source_year=")[1] for f in folders if f.startswith("kind=data/")}


def _by_year(file_years: Sequence[int]) -> dict[str, Column]:
    """Rows with a timestamp of each file year, to be counted while they are written."""
    dated = F.col("recorded_at").isNotNull()
    return {f"dated_{y}": F.count_if(dated & (F.col("source_year") == y)) for y in file_years}


def silver_rows(spark: SparkSession, lake: Lake) -> int:
    """Silver readings with a timestamp, as counted by the writes of their years."""
    counts = spark.read.schema("dated_rows long, source_year int").parquet(lake.path("counts", "readings"))
    return counts.agg(F.sum("dated_rows")).first()[0] or 0


@dataclass(frozen=True)
class Table:
    """A gold table and the serving table published from it. ``order`` is the sort inside a serving
    partition: the columns readers filter on. ``lookups`` have Bloom filters for single values."""

    columns: dict[str, str]
    key: tuple[str, ...]
    partition_by: tuple[str, ...]
    order: tuple[str, ...]
    lookups: tuple[str, ...] = ()


TABLES = {
    "daily_readings": Table(
        schemas.DAILY_READINGS_COLUMNS,
        schemas.DAILY_READINGS_KEY,
        schemas.DAILY_PARTITIONS,
        ("pollutant", "reading_date"),
        ("site_name",),
    ),
    "daily_weather": Table(
        schemas.DAILY_WEATHER_COLUMNS,
        schemas.DAILY_WEATHER_KEY,
        schemas.DAILY_PARTITIONS,
        ("reading_date",),
    ),
    "hourly_environment": Table(
        schemas.HOURLY_COLUMNS,
        schemas.HOURLY_KEY,
        schemas.HOURLY_PARTITIONS,
        ("pollutant", "recorded_at"),
        ("site_name", "recorded_at"),
    ),
}


def build_gold(
    spark: SparkSession, lake: Lake, years: Sequence[int] | None = None
) -> dict[str, DataFrame]:
    """Write the three gold tables and return them, whole, as read back.

    With ``years`` only the partitions that a refresh of those file years can change are computed
    and replaced.
    """
    _require(spark, lake, "silver", "readings", "weather")
    silver = {
        name: spark.read.parquet(lake.path("silver", name)) for name in ("readings", "weather")
    }

    def in_scope(name: str, table: Table) -> DataFrame:
        if years is None:
            return silver[name]
        return layers.rows_of_months(
            silver[name], layers.touched_months(years, table.partition_by)
        )

    def write(name: str, plan: Callable[[Table], DataFrame]) -> None:
        table = TABLES[name]
        months = set(layers.touched_months(years or (), table.partition_by))

        def touched(folder: dict[str, str]) -> bool:
            if "month" in folder:
                return (int(folder["year"]), int(folder["month"])) in months
            return int(folder["year"]) in {y for y, _ in months}

        layout.replace_partitions(
            plan(table),
            lake.path("gold", name),
            table.partition_by,
            table.key,
            whole_table=years is None,
            scope=touched,
        )

    plans = {
        "daily_readings": lambda t: daily.daily_readings(in_scope("readings", t)),
        "daily_weather": lambda t: daily.daily_weather(in_scope("weather", t)),
        "hourly_environment": lambda t: layers.hourly_environment(
            in_scope("readings", t), in_scope("weather", t)
        ),
    }
    _together(spark, *[partial(write, name, plan) for name, plan in plans.items()])
    return {name: spark.read.parquet(lake.path("gold", name)) for name in plans}


def quality_suites(gold: dict[str, DataFrame], silver_rows: int) -> list[expect.Suite]:
    """The three suites of the gate."""
    daily_readings = expect.Suite("daily_readings", gold["daily_readings"]).add(
        expect.row_count_of_grid(schemas.DAILY_READINGS_KEY),
        *[expect.not_null(c) for c in schemas.DAILY_READINGS_KEY],
        expect.between("min_value", low=0),
        expect.in_set("pollutant", sorted(schemas.MEASURES.values())),
        expect.between("completeness_pct", 0, 100),
        expect.pair_at_least("expected_readings", "valid_readings"),
    )
    daily_weather = expect.Suite("daily_weather", gold["daily_weather"]).add(
        expect.row_count_of_grid(schemas.DAILY_WEATHER_KEY),
        *[expect.not_null(c) for c in schemas.DAILY_WEATHER_KEY],
        expect.between("avg_temperature_2m", -20, 45),
        expect.between("temperature_completeness_pct", 0, 100),
    )
    hourly = expect.Suite("hourly_environment", gold["hourly_environment"]).add(
        expect.row_count_of_source(silver_rows),
        expect.match_percentage("temperature_2m", 99, 100),
    )
    return [daily_readings, daily_weather, hourly]


def publish_gold(
    gold: dict[str, DataFrame], lake: Lake, years: Sequence[int] | None = None
) -> dict[str, int]:
    """Upsert the gold tables, or their months touched by ``years``, into the serving tables;
    the partitions touched of each."""

    def publish(name: str, table: Table) -> int:
        changes = gold[name]
        if years is not None:
            months = layers.touched_months(years, table.partition_by)
            changes = changes.where(layers.in_months(F.col("year"), F.col("month"), months))
        return publish_table(changes, lake.path("serving", name), table)

    spark = next(iter(gold.values())).sparkSession
    touched = _together(spark, *[partial(publish, n, table) for n, table in TABLES.items()])
    return dict(zip(TABLES, touched))


def publish_table(changes: DataFrame, path: str, table: Table) -> int:
    return serving.publish(
        changes, path, table.columns, table.key, table.partition_by, table.order, table.lookups
    )


def served(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return serving.read_table(spark, lake.path("serving", name), TABLES[name].columns)


def run(
    spark: SparkSession,
    lake: Lake,
    strict: bool = True,
    refreshed: Sequence[int] | None = None,
    landed_at: str | None = None,
) -> dict[str, object]:
    """All steps in order; the first failing step raises and later ones do not start.

    The delivery counts as landed only after all tables are published, so a run that stops before is
    asked for again by ``changed_years``.

    ``refreshed`` (see ``changed_years``) limits the layers to those file years and the months they
    can change. The gate always judges the whole gold tables.
    """
    if refreshed is not None:
        _require_years(spark, lake, refreshed)
    readings_written, weather_written = _together(
        spark,
        partial(build_bronze_readings, spark, lake, refreshed),
        partial(build_bronze_weather, spark, lake, refreshed),
    )
    silver = build_silver(spark, lake, strict, refreshed)
    gold = build_gold(spark, lake, refreshed)
    verdicts = judge(spark, lake)
    published = publish_gold(gold, lake, refreshed)
    for table, written in (("readings", readings_written), ("weather", weather_written)):
        if written is not NOT_BEGUN:  # else a report that is there is of another, unfinished run
            accept_delivery(spark, lake, table, landed_at)
    return {
        "bronze": {"readings": readings_written, "weather": weather_written},
        "silver": silver,
        "verdicts": verdicts,
        "published": published,
    }


def _require_years(spark: SparkSession, lake: Lake, years: Sequence[int]) -> None:
    """One source may lag behind the other, but a year that neither has is a mistake."""
    for year in years:
        if not any(files.year_folders(spark, raw, [year]) for raw in (lake.raw_readings, lake.raw_weather)):
            raise MissingInputError(f"no raw files of {year} in {lake.raw_readings} or {lake.raw_weather}")


def judge(spark: SparkSession, lake: Lake) -> list[dict]:
    """The gate over the whole gold tables, against the counts that the silver writes took."""
    _require(spark, lake, "gold", *TABLES)
    _require(spark, lake, "counts", "readings")
    gold = {name: spark.read.parquet(lake.path("gold", name)) for name in TABLES}
    return expect.gate(quality_suites(gold, silver_rows(spark, lake)))
