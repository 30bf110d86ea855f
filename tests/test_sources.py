"""Listing, validation, change detection and readers on small files."""

import datetime as dt
import hashlib
import json
import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from stationlake.errors import BadRequestedYears, MissingInputError
from stationlake.session import stored
from stationlake.sources import checks, files, landing, lines, station_csv, weather_json

GOOD = """Data supplied by UK-AIR on 6/3/2026
All Data GMT hour ending
Status: R =Ratified P=Provisional,P*=As supplied
,,Station,,
Date,time,Nitrogen dioxide,status,unit
04-03-2026,07:00,4.25,R,ugm-3
05-03-2026,24:00:00,61.5,P,ugm-3
"""


def csv_problem(spark, text, year=2026, **options):
    folder = pathlib.Path(tempfile.mkdtemp()) / f"source_year={year}"
    folder.mkdir()
    (folder / "f.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    listed = checks.listed_with_digests(spark, str(folder.parent), "*.csv")
    return checks.csv_report(listed, lines.file_lines(spark, str(folder.parent), "*.csv"), **options).first()


def test_good_payload(spark):
    report = csv_problem(spark, GOOD)
    assert report.problem is None
    assert (report.row_count, report.latest_date) == (2, dt.date(2026, 3, 5))
    assert report.sha256 == hashlib.sha256(GOOD.encode()).hexdigest()
    assert report.header == ["Date", "time", "Nitrogen dioxide", "status", "unit"]
    assert report.encoding == "UTF-8"


@pytest.mark.parametrize(
    "text, problem",
    [
        ("", "empty"),
        ("  <HTML><body>no such file</body></html>", "html"),
        ("<!DOCTYPE html>\n" * 9, "html"),
        ("\n\t \r\n" * 3000 + "<!doctype html>\n" * 9, "html"),
        ("\n".join(GOOD.split("\n")[:5]), "no_data_rows"),
        (GOOD.replace("Data supplied", "Daten geliefert"), "preamble"),
        (GOOD.replace("Nitrogen dioxide", "Ozone"), "missing_columns"),
        (GOOD + "31-07-2026\n", None),
        (GOOD.replace("Date,time", "time,Date") + "01:00\n", "short_row"),
        (GOOD + "2026-07-31,01:00,1,P,ugm-3\n", "bad_date"),
        (GOOD + "31/07/2026,01:00,1,P,ugm-3\n ,, ,\n\n", None),
        (GOOD + "31-07-2025,01:00,1,P,ugm-3\n", "wrong_year"),
        ("\n".join(GOOD.split("\n")[:5]) + "\n , \n", "no_valid_rows"),
        ("﻿" + GOOD, None),
        (GOOD.replace("Station", "Orléans").encode("latin-1"), None),
        (GOOD.replace("\n", "\r\n"), None),
    ],
)
def test_payload_problems(spark, text, problem):
    assert csv_problem(spark, text).problem == problem


def test_size_limit(spark):
    report = csv_problem(spark, GOOD, max_bytes=20)
    assert report.problem == "too_large" and len(report.sha256) == 64 and report.row_count == 2
    assert csv_problem(spark, GOOD, max_bytes=None).problem is None


def weather(hours, **changes):
    hourly = {"time": hours}
    for name in ("temperature_2m", "relative_humidity_2m", "precipitation", "pressure_msl", "wind_speed_10m"):
        hourly[name] = [1.0] * len(hours)
    hourly.update(changes)
    return {"generationtime_ms": 3.5, "hourly": {k: v for k, v in hourly.items() if v is not ...}}


HOURS = ["2026-07-26T22:00", "2026-07-26T23:00"]


@pytest.mark.parametrize(
    "document, problem",
    [
        (weather(HOURS), None),
        ({"daily": {}}, "no_hourly"),
        (weather(HOURS, precipitation=...), "missing_fields"),
        (weather(HOURS, pressure_msl=7.0), "missing_fields"),
        (weather([]), "no_rows"),
        (weather(HOURS, wind_speed_10m=[1.0]), "length_mismatch"),
        (weather(["2025-12-31T23:00", *HOURS]), "starts_in_other_year"),
        (weather([*HOURS, "2027-01-01T00:00"]), "ends_in_other_year"),
    ],
)
def test_weather_problems(spark, document, problem):
    content = json.dumps(document).encode()
    df = spark.createDataFrame(
        [("w.json", len(content), bytearray(content), 2026)],
        "path string, length bigint, content binary, source_year int",
    )
    report = checks.weather_report(df).first()
    assert report.problem == problem
    if problem is None:
        assert (report.row_count, report.latest_timestamp) == (2, "2026-07-26T23:00")


def test_weather_digest_ignores_request_timing(spark):
    a, b = weather(HOURS), dict(reversed(weather(HOURS).items()))
    b["generationtime_ms"] = 99
    rows = [(n, 9, bytearray(json.dumps(d).encode()), 2026) for n, d in (("a", a), ("b", b))]
    df = spark.createDataFrame(rows, "path string, length bigint, content binary, source_year int")
    assert checks.weather_report(df).select("sha256").distinct().count() == 1


# ---- change detection -----------------------------------------------------------------------------


def test_sync_plan_vectors(spark):
    listing = spark.createDataFrame(
        [
            ("raw/year=2030/a", 100, 2030),
            ("raw/year=2029/a", 100, 2029),
            ("raw/year=2028/a", 100, 2028),
            ("raw/year=2027/a", 4096, 2027),
            ("raw/year=2026/a", 10, 2026),
            ("raw/readme", 5, None),
        ],
        "path string, length bigint, source_year int",
    )
    copies = listing.where("path NOT LIKE '%2026%'").withColumn(
        "length", F.when(F.col("source_year") == 2027, 10).otherwise(F.col("length"))
    )
    plan = landing.sync_plan(listing, copies.select("path", "length"), as_of_year=2030)
    assert {r.path: r.action for r in plan.collect()} == {
        "raw/year=2030/a": "fetch",
        "raw/year=2029/a": "fetch",
        "raw/year=2028/a": "skip",
        "raw/year=2027/a": "fetch",
        "raw/year=2026/a": "fetch",
        "raw/readme": "skip",
    }


def test_landing_plan(spark):
    schema = "path string, source_year int, sha256 string"
    delivered = spark.createDataFrame(
        [("a", 2026, "1"), ("b", 2026, "2"), ("c", 2020, "3"), ("d", 2020, "4")], schema
    )
    landed = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "x")], "path string, sha256 string")
    frozen = landing.landing_plan(delivered, landed, latest_year=2026)
    assert {r.path: r.status for r in frozen.collect()} == {
        "a": "unchanged", "b": "uploaded", "c": "frozen", "d": "uploaded",
    }
    plain = landing.landing_plan(delivered, landed)
    assert {r.path: r.status for r in plain.collect()}["c"] == "uploaded"


def test_years(spark):
    as_of = dt.date(2026, 7, 31)
    assert landing.refresh_years(as_of) == [2026, 2025]
    assert landing.available_through(as_of, 5) == dt.date(2026, 7, 26)
    assert landing.available_through(dt.date(2026, 1, 3), 5).year == 2025
    assert landing.backfill_years(dt.date(2022, 1, 1), as_of, 5) == [2022, 2023, 2024, 2025, 2026]
    assert landing.requested_years(["2026", 2025, 2026], 1990, 2026) == [2026, 2025]
    for bad in ([], [2027], [True], ["x"], [None], "2026", list(range(2000, 2011)), None):
        with pytest.raises(BadRequestedYears):
            landing.requested_years(bad, 1990, 2026)


def test_year_bounds(spark):
    years = landing.years_frame(spark, [2021, 2022, 2026, 2027])
    bounds = landing.year_bounds(years, dt.date(2022, 3, 1), dt.date(2026, 7, 31), 5)
    assert [(r.source_year, r.first_day, r.last_day) for r in bounds.orderBy("source_year").collect()] == [
        (2022, dt.date(2022, 3, 1), dt.date(2022, 12, 31)),
        (2026, dt.date(2026, 1, 1), dt.date(2026, 7, 26)),
    ]


def test_paths():
    assert landing.landing_path("raw/", "station", 2026, "s_2026.csv") == "raw/station/year=2026/s_2026.csv"
    key = "raw/open/year=2026/w_2026.json"
    assert landing.mirrored_path(key, "raw", "/data/raw") == "/data/raw/open/year=2026/w_2026.json"
    assert landing.mirrored_path("else/w.json", "raw/", "/data/raw/") == "/data/raw/else/w.json"


def test_listing(spark, tmp_path):
    with pytest.raises(MissingInputError):
        files.require_files(spark, str(tmp_path / "none"), "*.csv")
    folder = tmp_path / "year=2024"
    folder.mkdir()
    (folder / "a.json").write_text("{}")
    with pytest.raises(MissingInputError):
        files.require_files(spark, str(tmp_path), "*.csv")
    (folder / "a.csv").write_text("12345")
    (row,) = files.require_files(spark, str(tmp_path), "*.csv").collect()
    assert (row.length, row.source_year) == (5, 2024)


# ---- readers ----------------------------------------------------------------------------------------


def test_unique_names():
    header = ["Date", "status", "unit", "Status", "unit", "status"]
    assert station_csv.unique_names(header) == ["Date", "status", "unit", "Status_1", "unit_1", "status_2"]


def test_files_of_different_layout(spark, tmp_path):
    head = GOOD.split("\n")[:4]
    one = [*head, "Date,time,Nitrogen dioxide,status,Ozone,status"]
    one += ['01-01-2024,01:00,"1.5",R,N/A,R', "01-01-2024,02:00,NA,R", "02-01-2024,24:00,3,R,4,R,x,y"]
    one += ["01-01-2024,03:00, ,R,0,R", ",,,,,", "", " ,04:00,9,R,9,R"]
    two = [*head[:3], ",,Orléans,,"]
    two += ["Date,time,Ozone,status,Nitrogen dioxide,status,comment", "1/1/2025,01:00,8,P,7,P,été"]
    for year, lines, encoding in ((2024, one, "utf-8"), (2025, two, "latin-1")):
        folder = tmp_path / f"source_year={year}"
        folder.mkdir()
        (folder / f"s_{year}.csv").write_bytes("\n".join(lines).encode(encoding))
    report = checks.station_report(spark, str(tmp_path), "*.csv")
    # the reader takes files as they are; only the landing rule on blank dates is not met here
    report = report.withColumn("problem", F.lit(None).cast("string"))
    rows = station_csv.classified_rows(station_csv.read_station_csv(spark, report, str(tmp_path), "*.csv"))
    good = station_csv.data_rows(rows).orderBy("source_year", "time").collect()
    assert [(r.source_year, r.time, r["Nitrogen dioxide"], r.Ozone, r.status, r.comment) for r in good] == [
        (2024, "01:00", "1.5", None, "R", None),
        (2024, "03:00", None, "0", "R", None),
        (2025, "01:00", "7", "8", "P", "été"),
    ]
    assert {r.source_file for r in good} == {"s_2024.csv", "s_2025.csv"}
    assert sorted(r.line for r in station_csv.malformed_rows(rows, report).collect()) == [
        "01-01-2024,02:00,NA,R",
        "02-01-2024,24:00,3,R,4,R,x,y",
    ]


def test_a_digest_needs_no_file_in_a_row(spark, tmp_path):
    texts = {"a": b"", "b": b"\n", "c": b"x", "d": b"x\n\n", "e": b"\r\n\xff\xfe\n,", "f": "\ufeffBOM\n".encode()}
    texts["large"] = b"".join(b"%d,some cells,of a line\r\n" % k for k in range(150_000))
    for name, content in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = checks.listed_with_digests(spark, str(tmp_path), "*.csv")
        got = {r.path.split("/")[-1][:-4]: r.sha256 for r in found.collect()}
        plan = lines.file_digests(spark, str(tmp_path), "*.csv")._jdf.queryExecution().toString()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5  # the large file is several blocks
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {name: hashlib.sha256(content).hexdigest() for name, content in texts.items()}
    assert "binaryFile" not in plan and "content" not in plan


def test_one_scan_for_a_hundred_layouts(spark, tmp_path):
    head = GOOD.split("\n")[:4]
    for k in range(100):
        folder = tmp_path / f"year={1950 + k % 50}" / f"site=s {k}"
        folder.mkdir(parents=True)
        body = [f"Date,time,Nitrogen dioxide,extra {k},extra {k}", f"0{1 + k % 9}-01-{1950 + k % 50},01:00,{k},a,b"]
        (folder / "f.csv").write_text("\n".join([*head, *body]) + "\n")
    report = stored(checks.station_report(spark, str(tmp_path), "*.csv"), "report")
    rows = station_csv.read_station_csv(spark, report, str(tmp_path), "*.csv")
    assert len(rows.columns) == 3 + 200 + 5
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    got = {(r.site, r["Nitrogen dioxide"], r.source_year) for r in rows.collect()}
    assert got == {(f"s {k}", str(k), 1950 + k % 50) for k in range(100)}
    for r in rows.where("site = 's 7'").collect():
        assert (r["extra 7"], r["extra 7_1"], r["extra 8"]) == ("a", "b", None)


def test_heads_of_files_in_several_blocks(spark, tmp_path):
    body = "".join(f"{1 + k % 28:02}-{1 + k % 12:02}-2026,{k % 24:02}:00,{k},R,ugm-3\n" for k in range(40_000))
    (tmp_path / "year=2026").mkdir()
    (tmp_path / "year=2026" / "long.csv").write_text(GOOD + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        (row,) = checks.station_report(spark, str(tmp_path), "*.csv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row.problem, row.row_count, row.bad_dates) == (None, 40_002, 0)
    assert row.header[:3] == ["Date", "time", "Nitrogen dioxide"] and len(row.preamble) == 4


@pytest.mark.parametrize(
    "line, want",
    [("a,b,,c", ["a", "b", "", "c"]), ('"a,b",c', ["a,b", "c"]), ('"say ""hi""",x', ['say "hi"', "x"]), ("", [""])],
)
def test_cells_of_a_line(spark, line, want):
    table = spark.createDataFrame([(line,)], "line string")
    assert table.select(lines.cells(F.col("line"))).first()[0] == want


def test_weather_documents(spark, tmp_path):
    folder = tmp_path / "source_year=2026"
    folder.mkdir()
    (folder / "w_2026.json").write_text(json.dumps(weather(HOURS, precipitation=[0.0, None]), indent=1))
    flat = weather_json.flatten_documents(weather_json.read_weather_documents(spark, str(tmp_path)))
    rows = flat.orderBy("recorded_at").collect()
    assert [(r.recorded_at, r.precipitation, r.source_year, r.source_file) for r in rows] == [
        (HOURS[0], 0.0, 2026, "w_2026.json"),
        (HOURS[1], None, 2026, "w_2026.json"),
    ]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """One task a folder took most of a listing's time; the setting of the session stays as it was."""
    for k in range(100):
        folder = tmp_path / "source_year=2026" / f"site={k}"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text(GOOD)
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    context = spark.sparkContext
    read = {
        "text": lambda: lines.text_scan(spark, str(tmp_path), "*.csv"),
        "listing": lambda: files.file_listing(spark, str(tmp_path), "*.csv"),
    }
    for name, load in read.items():
        context.setJobGroup(f"listing-{name}", name)
        assert load().count() == {"text": 700, "listing": 100}[name]
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup(f"listing-{name}") for s in tracker.getJobInfo(job).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * context.defaultParallelism
    context.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(setting) == before


def test_a_report_reuses_the_listing_and_the_scan(spark, tmp_path, monkeypatch):
    folder = tmp_path / "source_year=2026"
    folder.mkdir()
    (folder / "f.csv").write_text(GOOD)
    want = checks.station_report(spark, str(tmp_path), "*.csv").collect()
    listing = files.file_listing(spark, str(tmp_path), "*.csv")
    scan = lines.text_scan(spark, str(tmp_path), "*.csv")
    for module, name in ((checks, "file_listing"), (checks, "text_scan"), (lines, "text_scan")):
        monkeypatch.setattr(module, name, None)
    assert checks.station_report(spark, str(tmp_path), "*.csv", listing=listing, scan=scan).collect() == want
