"""Cells, dates, times and digests: fixed vectors and properties."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stationlake.functions import cells, clock, fingerprint
from stationlake.operators.cleaning import clean_readings, stamp


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", expression(F.col("x")).alias("y"))
    return [r.y for r in df.orderBy("i").collect()]


def moments(spark, pairs, strict=True):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, d string, t string")
    at = clock.at_clock(clock.parse_date(F.col("d")), F.col("t"), strict)
    return [r.y for r in df.select("i", at.alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    given_cells = ["12.5", " 12.5 ", "1e3", ".5", "5.", "+1", "1_000", "-0.5", "0", None]
    assert column(spark, given_cells, cells.to_number) == [
        12.5, 12.5, 1000.0, 0.5, 5.0, 1.0, 1000.0, -0.5, 0.0, None,
    ]
    refused = ["", "bad-value", "1,5", "0x10", "1d", "1.5f", "_1", "1__0", "1e", "12 3", "--1"]
    assert column(spark, refused, cells.to_number) == [None] * len(refused)


def test_nan_and_infinity(spark):
    kept = column(spark, ["NaN", "-nan", "inf", "-Infinity"], cells.to_number)
    assert kept[0] != kept[0] and kept[1] != kept[1]
    assert kept[2:] == [float("inf"), float("-inf")]
    as_null = column(spark, ["NaN", "inf", "1"], lambda c: cells.to_number(c, "null"))
    assert as_null == [None, None, 1.0]
    with pytest.raises(ValueError):
        cells.to_number(F.lit("1"), "drop")


def test_cleaning_keeps_zero_and_drops_negative(spark):
    df = spark.createDataFrame(
        [(0, "-0.5"), (1, "0"), (2, "12.5"), (3, "bad-value"), (4, "NA"), (5, " "), (6, None)],
        "i int, cell string",
    )
    got = [r.value for r in clean_readings(df).orderBy("i").collect()]
    assert got == [None, 0.0, 12.5, None, None, None, None]


def test_null_tokens_are_exact(spark):
    got = column(spark, ["", " ", "NA", "N/A", "na", " NA", "x"], cells.blank_tokens_to_null)
    assert got == [None, None, None, None, "na", " NA", "x"]


@pytest.mark.parametrize(
    "pair, expected",
    [
        (("1/1/2024", "13:00"), dt.datetime(2024, 1, 1, 13)),
        (("2024-03-15", "09:00"), dt.datetime(2024, 3, 15, 9)),
        (("1/1/2024", "24:00"), dt.datetime(2024, 1, 2)),
        (("31/12/2024", "24:00"), dt.datetime(2025, 1, 1)),
        (("30/07/2026", "24:00:00"), dt.datetime(2026, 7, 31)),
        (("30-07-2026", "23:00"), dt.datetime(2026, 7, 30, 23)),
        (("2024-02-28 00:00:00", " 24:00 "), dt.datetime(2024, 2, 29)),
        (("29/2/2024", "24:00"), dt.datetime(2024, 3, 1)),
        (("2024-01-01", "9:05:07"), dt.datetime(2024, 1, 1, 9, 5, 7)),
        (("not a date", "10:00"), None),
        (("2024", "10:00"), None),
        (("2024-01-01", None), None),
        ((None, "25:00"), None),
    ],
)
def test_timestamps(spark, pair, expected):
    assert moments(spark, [pair]) == [expected]


@pytest.mark.parametrize("time", ["25:00", "24:30", "24:00:01", "12:60", "noon", "12"])
def test_impossible_times(spark, time):
    assert moments(spark, [("1/1/2024", time)], strict=False) == [None]
    with pytest.raises(PySparkException, match="not a time of day"):
        moments(spark, [("1/1/2024", time)])


def test_dates(spark):
    given_cells = ["31/02/2024", "1/13/2024", "30/07-2026", "2024-1-5", "20240105", "2024-01-05 25:00:00"]
    assert column(spark, given_cells, clock.parse_date) == [
        None, None, None, dt.date(2024, 1, 5), None, None,
    ]
    strict = column(spark, ["2024-01-05", "5-1-2024"], lambda c: clock.parse_date(c, True))
    assert strict == [None, dt.date(2024, 1, 5)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2090, 12, 31)), min_size=1, max_size=40))
def test_rollover_is_the_date_plus_a_day(spark, days):
    shapes = ["{0:%d/%m/%Y}", "{0:%Y-%m-%d}", "{0:%d-%m-%Y}", "{0.day}/{0.month}/{0.year}"]
    pairs = [(shapes[i % 4].format(d), ("24:00", "24:00:00")[i % 2]) for i, d in enumerate(days)]
    expected = [dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1) for d in days]
    assert moments(spark, pairs) == expected


def test_results_do_not_depend_on_the_session_zone(spark):
    pairs = [("31/03/2024", "02:30"), ("31/03/2024", "24:00")]
    hour = "SELECT timestamp_ntz'2024-03-31 02:45:00' AS t"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert moments(spark, pairs) == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 4, 1)]
        floored = spark.sql(hour).select(clock.hour_floor(F.col("t")).alias("h")).first().h
        assert floored == dt.datetime(2024, 3, 31, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stamp_drops_rows_without_a_date(spark):
    df = spark.createDataFrame([("1/1/2024", "01:00"), ("?", "01:00")], "d string, t string")
    assert stamp(df, "d", "t").count() == 1


def test_canonical_json(spark):
    a = '{"hourly": {"time": [1, 2]}, "generationtime_ms": 0.1, "a": "ü"}'
    b = '{"a":"ü","generationtime_ms":77,"hourly":{"time":[1,2]}}'
    texts = column(spark, [a, b], lambda c: fingerprint.canonical_json(c, ["generationtime_ms"]))
    assert texts[0] == texts[1] == '{"a":"ü","hourly":{"time":[1,2]}}'
    other = column(spark, ['{"a": 2}'], fingerprint.canonical_json)[0]
    assert json.loads(other) == {"a": 2}


def test_fingerprint_ignores_order_but_not_repetition(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "a string, b int")
        digest = fingerprint.row_digest(["b", "a"])
        return df.select(digest.alias("d")).agg(fingerprint.dataset_fingerprint(F.col("d"))).first()[0]

    assert of([("x", 1), ("y", None)]) == of([("y", None), ("x", 1)])
    assert of([("x", 1)]) != of([("x", 1), ("x", 1)])
    assert of([("", 1)]) != of([(None, 1)])
