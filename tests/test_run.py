"""The whole flow on generated raw files whose row counts are known beforehand.

Readings: hours ending 2022-01-01 01:00 to 2026-07-31 00:00, 7 pollutants. Weather: hours 2022-01-01
00:00 to 2026-07-26 23:00. 40,128 reading hours, 40,032 weather hours, of which 40,031 match.
"""

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.__main__ import main
from stationlake.errors import KeyViolation, MissingInputError, QualityGateFailed, RawFileRejected
from stationlake.plans import inspect, layers, run, views
from stationlake.sources import landing

FIRST, LAST_READING, LAST_WEATHER = dt.date(2022, 1, 1), dt.date(2026, 7, 30), dt.date(2026, 7, 26)
HEADER = "Date,time," + ",".join(f"{raw},status,unit" for raw in schemas.MEASURES)
TOP = [
    "Data supplied by UK-AIR on 31/7/2026",
    "All Data GMT hour ending",
    "Status: R =Ratified P=Provisional,P*=As supplied",
    ",,Station,,",
    HEADER,
]


def days(first, last):
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def station_file(year, value="12.5"):
    lines = list(TOP)
    for day in days(dt.date(year, 1, 1), min(dt.date(year, 12, 31), LAST_READING)):
        for hour in range(1, 25):
            time = ("24:00:00" if year % 2 else "24:00") if hour == 24 else f"{hour:02}:00"
            cells = [f"{day:%d-%m-%Y}", time]
            for n in range(7):
                cell = {2: "", 3: "-1", 4: "bad-value"}.get(hour, value) if n == 0 else value
                cells += [cell, "R", "ugm-3"]
            lines.append(",".join(cells))
    return "\n".join(lines) + "\n"


def weather_file(year, last=LAST_WEATHER):
    times = [
        f"{day}T{hour:02}:00"
        for day in days(dt.date(year, 1, 1), min(dt.date(year, 12, 31), last))
        for hour in range(24)
    ]
    hourly = {"time": times, **{m: [10.0] * len(times) for m in schemas.WEATHER_MEASURES}}
    return json.dumps({"generationtime_ms": 1.5, "hourly": hourly})


def write_raw(base, years):
    for year in years:
        for kind, name, text in (
            ("stations", f"station_{year}.csv", station_file(year)),
            ("weather", f"weather_{year}.json", weather_file(year)),
        ):
            folder = base / "raw" / kind / f"source_year={year}"
            folder.mkdir(parents=True)
            (folder / name).write_text(text)


def lake_in(base):
    return run.Lake(str(base / "raw" / "stations"), str(base / "raw" / "weather"), str(base / "lake"))


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("full")
    write_raw(base, range(2022, 2027))
    lake = lake_in(base)
    return base, lake, run.run(spark, lake)


def test_layer_counts(full):
    _, _, outcome = full
    assert outcome["bronze"] == {"readings": {"rows": 40128}, "weather": {"rows": 40032}}
    silver = outcome["silver"]
    assert silver["readings"] == {"rows": 280896, "valid": 280896 - 3 * 1672}
    assert silver["weather"] == {"rows": 40032}
    assert all(v.passed for v in outcome["verdicts"])


def test_published_counts(spark, full):
    _, lake, _ = full
    assert run.served(spark, lake, "daily_readings").count() == 11711
    assert run.served(spark, lake, "daily_weather").count() == 1668
    hourly = run.served(spark, lake, "hourly_environment")
    found = hourly.agg(F.count("*"), F.count("temperature_2m"), F.count_distinct("recorded_at")).first()
    assert tuple(found) == (280896, 40031 * 7, 40128)
    ends = run.served(spark, lake, "daily_readings").where("pollutant = 'NO'").orderBy("reading_date")
    first, last = ends.first(), ends.orderBy(F.desc("reading_date")).first()
    assert (str(first.reading_date), first.expected_readings) == ("2022-01-01", 23)
    assert (str(last.reading_date), last.expected_readings) == ("2026-07-31", 1)


def test_year_ends(spark, full):
    _, lake, _ = full
    silver = spark.read.parquet(lake.path("silver", "readings"))
    midnight = silver.where("recorded_at = timestamp_ntz'2025-01-01 00:00:00'")
    assert {(r.year, r.source_year) for r in midnight.collect()} == {(2024, 2024)}
    gold = spark.read.parquet(lake.path("gold", "daily_readings"))
    assert {r.year for r in gold.where("reading_date = date'2025-01-01'").collect()} == {2025}


def test_missing_is_not_zero(spark, full):
    _, lake, _ = full
    row = (
        run.served(spark, lake, "daily_readings")
        .where("pollutant = 'PM10' AND reading_date = date'2023-05-05'")
        .first()
    )
    assert (row.expected_readings, row.valid_readings, row.completeness_pct) == (24, 21, 87.5)
    assert row.min_value == 12.5


def test_inspection(spark, full):
    _, lake, _ = full
    found = inspect.inspect_raw(spark, lake, [2024, 2025])
    assert found["columns"].groupBy("status").count().collect() == [("OK", 2 * 9)]
    rows = {r.source_year: r for r in found["rows"].collect()}
    assert tuple(rows[2024])[1:] == (366 * 24, 366 * 24, 0, 366)
    assert tuple(rows[2025])[1:] == (365 * 24, 365 * 24, 0, 0)  # this file spells it 24:00:00
    first = list(schemas.MEASURES)[0]
    cells = {(r.source_year, r.column_name): r for r in found["measures"].collect()}
    assert len(cells) == 14
    assert (cells[2024, first].negative_readings, cells[2024, first].missing_readings) == (366, 732)
    silver = inspect.inspect_silver(spark, lake, 2024)
    assert silver["sample"].count() == 30
    assert {r.total_rows for r in silver["completeness"].collect()} == {366 * 24}
    span = silver["range"].first()
    assert (str(span.min_recorded_at), str(span.max_recorded_at)) == ("2024-01-01 01:00:00", "2025-01-01 00:00:00")


def test_incremental_refresh_equals_full_run(spark, full, tmp_path):
    """Through the command line: a first full run, then only what changed."""
    base, _, _ = full
    for kind in ("stations", "weather"):
        for year in (2023, 2024, 2025):
            folder = f"raw/{kind}/source_year={year}"
            shutil.copytree(base / folder, tmp_path / folder)
    lake = lake_in(tmp_path)

    def job(*extra, root=lake.root):
        return main(["--readings", lake.raw_readings, "--weather", lake.raw_weather, "--root", root, *extra])

    assert run.changed_years(spark, lake, 2025) == [2023, 2024, 2025]
    job()
    assert job("--changed-as-of", "2025") is None

    revised = tmp_path / "raw" / "stations" / "source_year=2024" / "station_2024.csv"
    revised.write_text(station_file(2024, value="99.5"))
    assert run.changed_years(spark, lake, 2025, "weather") == []
    outcome = job("--changed-as-of", "2025")
    assert all(outcome["published"].values())
    assert outcome["bronze"]["readings"] == {"rows": 366 * 24}

    refreshed = run.served(spark, lake, "daily_readings")
    by_date = {str(r.reading_date): r for r in refreshed.where("pollutant = 'O3'").collect()}
    assert by_date["2024-01-01"].min_value == 12.5  # its midnight came with the file of 2023
    assert by_date["2024-01-01"].expected_readings == 24
    assert by_date["2024-06-01"].min_value == 99.5
    assert by_date["2025-01-01"].max_value == 99.5  # its midnight came with the file of 2024
    assert by_date["2025-01-01"].expected_readings == 24
    assert by_date["2023-12-31"].max_value == 12.5

    again = run.Lake(lake.raw_readings, lake.raw_weather, str(tmp_path / "again"))
    job(root=again.root)
    for name in run.TABLES:
        a, b = run.served(spark, lake, name), run.served(spark, again, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def small(base):
    """One year whose weather is as recent as its readings."""
    write_raw(base, [2026])
    weather = base / "raw" / "weather" / "source_year=2026" / "weather_2026.json"
    weather.write_text(weather_file(2026, LAST_READING))
    return lake_in(base)


def test_rejected_files_stop_the_run(spark, tmp_path):
    lake = small(tmp_path)
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    good = raw.read_text()
    raw.write_text("<html>busy</html>")
    with pytest.raises(RawFileRejected, match="html"):
        run.run(spark, lake)
    assert not (tmp_path / "lake" / "bronze" / "readings").exists()
    assert not (tmp_path / "lake" / "silver").exists()
    raw.write_text(good)
    weather = tmp_path / "raw" / "weather" / "source_year=2026" / "weather_2026.json"
    document = json.loads(weather.read_text())
    document["hourly"]["precipitation"].pop()
    weather.write_text(json.dumps(document))
    with pytest.raises(RawFileRejected, match="length_mismatch"):
        run.run(spark, lake)


def test_failed_gate_publishes_nothing(spark, tmp_path):
    lake = small(tmp_path)
    weather = tmp_path / "raw" / "weather" / "source_year=2026" / "weather_2026.json"
    document = json.loads(weather.read_text())
    document["hourly"]["temperature_2m"] = [60.0] * len(document["hourly"]["time"])
    weather.write_text(json.dumps(document))
    with pytest.raises(QualityGateFailed, match="avg_temperature_2m"):
        run.run(spark, lake)
    assert not (tmp_path / "lake" / "serving").exists()


def test_a_year_the_lagging_source_has_not_begun(spark, full, tmp_path):
    _, lake, _ = full
    begun = run.Lake(lake.raw_readings, str(tmp_path), str(tmp_path / "lake"))
    (tmp_path / "source_year=2025").mkdir()
    (tmp_path / "source_year=2025" / "w.json").write_text(weather_file(2025))
    assert run.build_bronze_weather(spark, begun, [2026]) == {"rows": 0}
    assert run.build_bronze_weather(spark, begun, [2025, 2026]) == {"rows": 8760}


def test_missing_input(spark, tmp_path):
    with pytest.raises(MissingInputError):
        run.run(spark, lake_in(tmp_path))


def test_impossible_time_fails_strictly_or_is_quarantined(spark, tmp_path):
    lake = small(tmp_path)
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    raw.write_text(raw.read_text().replace("15-03-2026,07:00", "15-03-2026,25:00"))
    raw.write_text(raw.read_text() + "30-07-2026,23:00,1,R,ugm-3\n")
    assert run.build_bronze_readings(spark, lake) == {"rows": 24 * 211}
    (line,) = run.malformed_lines(spark, lake).collect()
    assert (line.line, line.source_file) == ("30-07-2026,23:00,1,R,ugm-3", "station_2026.csv")
    bronze = run.bronze_readings(spark, lake)
    with pytest.raises(Exception, match="not a time of day"):
        layers.silver_readings(bronze).collect()
    total = 7 * 24 * 211
    assert layers.silver_readings(bronze, strict=False).count() == total - 7
    (bad,) = layers.quarantined_times(bronze).collect()
    assert (bad.Date, bad.time, bad.reason) == ("15-03-2026", "25:00", "bad_time")


def test_repeated_hours_cannot_be_published(spark, tmp_path):
    lake = small(tmp_path)
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    raw.write_text(raw.read_text() + raw.read_text().splitlines()[-1] + "\n")
    with pytest.raises(KeyViolation):
        run.run(spark, lake)


def tables_of(spark, lake):
    return {name: sorted(map(str, run.served(spark, lake, name).collect())) for name in run.TABLES}


def test_a_refresh_that_fails_is_asked_for_again(spark, tmp_path, monkeypatch):
    lake = small(tmp_path)
    run.run(spark, lake, landed_at="2026-08-01T00:00:00Z")
    landed = spark.read.parquet(lake.path("landing", "readings")).first()
    assert (landed.source, landed.landed_at) == ("readings", "2026-08-01T00:00:00Z")
    assert run.changed_years(spark, lake, 2026) == []
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    raw.write_text(station_file(2026, value="40.5"))

    def stopped(*_, **__):
        raise RuntimeError("driver lost")

    published = []

    def one_table_only(changes, path, table):
        if published:
            raise RuntimeError("driver lost")
        published.append(path)
        return publish(changes, path, table)

    publish = run.publish_table
    for step, stand_in in (
        ("build_silver", stopped),
        ("build_gold", stopped),
        ("judge", stopped),
        ("publish_table", one_table_only),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(run, step, stand_in)
            with pytest.raises(RuntimeError):
                run.run(spark, lake, refreshed=[2026])
        assert run.changed_years(spark, lake, 2026) == [2026]
    run.run(spark, lake, refreshed=[2026], landed_at="2026-08-02T00:00:00Z")
    assert run.changed_years(spark, lake, 2026) == []
    assert spark.read.parquet(lake.path("landing", "readings")).first().landed_at == "2026-08-02T00:00:00Z"
    assert spark.read.parquet(lake.path("landing", "weather")).first().landed_at == "2026-08-01T00:00:00Z"
    again = run.Lake(lake.raw_readings, lake.raw_weather, str(tmp_path / "again"))
    run.run(spark, again)
    assert tables_of(spark, lake) == tables_of(spark, again)


def test_year_folders_and_odd_paths(spark, tmp_path):
    """The layout that ``landing_path`` writes, below a folder with a blank, a percent sign and a plus."""
    base = tmp_path / "my lake 5%+"
    for site, value in (("North Park", "12.5"), ("a+b 100%", "7.5")):
        folder = base / "raw" / landing.landing_path("", "stations", 2026, f"site={site}").strip("/")
        folder.mkdir(parents=True)
        (folder / "hours.CSV").write_text(station_file(2026, value))
    folder = base / "raw" / "weather" / "year=2026"
    folder.mkdir(parents=True)
    (folder / "w.Json").write_text(weather_file(2026, LAST_READING))
    lake = lake_in(base)
    assert run.changed_years(spark, lake, 2026) == [2026]
    outcome = run.run(spark, lake)
    assert outcome["bronze"]["readings"] == {"rows": 2 * 24 * 211}
    served = run.served(spark, lake, "daily_readings").where("pollutant = 'NO'")
    assert {(r.site_name, r.max_value) for r in served.collect()} == {("North Park", 12.5), ("a+b 100%", 7.5)}
    assert run.malformed_lines(spark, lake).isEmpty()
    (folder / "w.Json").write_text(weather_file(2026, LAST_READING).replace("10.0", "11.0"))
    assert run.changed_years(spark, lake, 2026, "weather") == [2026]
    run.run(spark, lake, refreshed=[2026])
    assert {r.max_temperature_2m for r in run.served(spark, lake, "daily_weather").collect()} == {11.0}


def test_a_year_that_no_source_has(spark, tmp_path):
    with pytest.raises(MissingInputError, match="2031"):
        run.run(spark, small(tmp_path), refreshed=[2031])


def test_layers_ask_for_what_they_need(spark, tmp_path):
    lake = lake_in(tmp_path)
    for step in (run.build_silver, run.build_gold, run.judge, run.malformed_lines):
        with pytest.raises(MissingInputError):
            step(spark, lake)


def test_inspection_shows_rejected_files(spark, tmp_path):
    lake = lake_in(tmp_path)
    write_raw(tmp_path, [2025, 2026])
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    raw.write_text(raw.read_text() + "2026-07-31,01:00,1,R,ugm-3\n")
    found = inspect.inspect_raw(spark, lake)
    assert {(r.source_year, r.problem) for r in found["columns"].collect()} == {(2025, None), (2026, "bad_date")}
    assert {r.source_year for r in found["rows"].collect()} == {2025, 2026}
    with pytest.raises(MissingInputError):
        inspect.inspect_raw(spark, lake, [2031])


def test_a_revision_that_drops_a_month(spark, tmp_path):
    lake = small(tmp_path)
    run.run(spark, lake)
    raw = tmp_path / "raw" / "stations" / "source_year=2026" / "station_2026.csv"
    raw.write_text("\n".join(l for l in raw.read_text().split("\n") if "-03-2026," not in l))
    run.run(spark, lake, refreshed=run.changed_years(spark, lake, 2026))
    gold = spark.read.parquet(lake.path("gold", "hourly_environment"))
    days = {str(r.d) for r in gold.where("month = 3").selectExpr("date(recorded_at) d").distinct().collect()}
    assert days <= {"2026-03-01"}  # the midnight that February's last day delivers


def test_views_of_a_lake(spark, full):
    _, lake, _ = full
    names = views.register_views(spark, lake)
    assert set(names) >= {"bronze_readings", "bronze_malformed", "silver_readings", "gold_daily_readings", "serving_hourly_environment"}
    (row,) = spark.sql("SELECT count(*) AS n, count(DISTINCT pollutant) AS kinds FROM silver_readings").collect()
    assert (row.n, row.kinds) == (spark.read.parquet(lake.path("silver", "readings")).count(), 7)
    plan = spark.sql("SELECT value FROM silver_readings WHERE source_year = 2026 AND pollutant = 'NO2'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_year" in text and "EqualTo(pollutant,NO2)" in text


def test_the_gate_uses_the_counts_of_the_writes(spark, full):
    _, lake, _ = full
    dated = spark.read.parquet(lake.path("silver", "readings")).where("recorded_at IS NOT NULL")
    assert run.silver_rows(spark, lake) == dated.count() > 0
    by_year = {r.source_year: r["count"] for r in dated.groupBy("source_year").count().collect()}
    kept = spark.read.parquet(lake.path("counts", "readings")).collect()
    assert {r.source_year: r.dated_rows for r in kept} == by_year
    before = run.silver_rows(spark, lake)
    run.build_silver(spark, lake, years=[2026])
    assert run.silver_rows(spark, lake) == before


def test_inspection_reads_the_files_once(spark, full):
    _, lake, _ = full
    found = inspect.inspect_raw(spark, lake)
    for name in ("rows", "measures"):
        plan = found[name]._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan
    assert found["rows"].count() and found["measures"].count()
