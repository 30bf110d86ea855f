"""Reshaping, metrics, joins, keys, expectations, profiles, and serving tables."""

import datetime as dt
import pathlib
from collections import defaultdict
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.errors import KeyViolation, MissingColumnError, QualityGateFailed
from stationlake.functions import clock
from stationlake.operators import colocated, daily, enrich, expect, keys, layout, profile, serving
from stationlake.operators.reshape import unpivot_measures
from stationlake.plans import layers
from stationlake.session import scratch_dir, stored

T0 = dt.datetime(2024, 1, 1)
READING = "recorded_at timestamp_ntz, site_name string, pollutant string, value double"


def hours(n):
    return T0 + dt.timedelta(hours=n)


# ---- reshape ----------------------------------------------------------------------------------------


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.sampled_from(["1", "x"]))] * 3), min_size=1, max_size=30))
def test_unpivot_keeps_every_cell(spark, cells):
    wide = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, `a.1` string, `b c` string, d string")
    long = unpivot_measures(wide, ["i"], {"a.1": "PM2.5", "b c": "B", "d": "D"})
    got = sorted((r.i, r.pollutant, r.value or "") for r in long.collect())
    want = sorted((i, n, c[j] or "") for i, c in enumerate(cells) for j, n in enumerate(("PM2.5", "B", "D")))
    assert got == want


def test_unpivot_is_one_scan_with_one_expand(spark, sf_dir):
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    long = unpivot_measures(wide, ["l_orderkey"], {"l_quantity": "q", "l_tax": "t"})
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_unpivot_needs_its_columns(spark):
    with pytest.raises(MissingColumnError):
        unpivot_measures(spark.range(1), ["id"], {"nope": "n"})


# ---- metrics ----------------------------------------------------------------------------------------

reading = st.tuples(
    st.integers(0, 72),
    st.sampled_from(["s1", "s2"]),
    st.sampled_from(["NO", "O3"]),
    st.one_of(st.none(), st.integers(0, 50)),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(reading, min_size=1, max_size=60))
def test_daily_readings_against_brute_force(spark, rows):
    df = spark.createDataFrame([(hours(h), s, p, None if v is None else float(v)) for h, s, p, v in rows], READING)
    groups = defaultdict(list)
    for h, s, p, v in rows:
        groups[(hours(h).date(), s, p)].append(v)
    got = daily.daily_readings(df).collect()
    assert len(got) == len(groups)
    for r in got:
        cells = groups[(r.reading_date, r.site_name, r.pollutant)]
        valid = [v for v in cells if v is not None]
        assert r.expected_readings == len(cells) == r.valid_readings + r.missing_readings
        assert r.valid_readings == len(valid)
        assert r.completeness_pct == pytest.approx(100 * len(valid) / len(cells), abs=0.0051)
        if valid:
            assert (r.min_value, r.max_value) == (min(valid), max(valid))
            assert r.avg_value == pytest.approx(sum(valid) / len(valid))
        else:
            assert r.avg_value is r.min_value is r.max_value is None
        assert (r.year, r.month) == (r.reading_date.year, r.reading_date.month)


def test_summaries_of_no_rows(spark):
    none = spark.createDataFrame([], READING)
    assert daily.layer_counts(none).first().total_rows == 0
    assert daily.daily_readings(none).count() == 0
    assert enrich.match_coverage(none, "value").first().match_pct is None


# ---- join -------------------------------------------------------------------------------------------


def skewed(spark, n=3000):
    """A third of all readings at one hour, a few without a time, the others spread."""
    hour = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 40)
    return spark.range(n).select(
        F.col("id").alias("n"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))).alias("recorded_at"),
    )


def reference_rows(spark, count=30):
    return spark.createDataFrame(
        [(hours(h), f"c{h}", float(h)) for h in range(count)] + [(None, "?", 0.0), (None, "?", 1.0)],
        "recorded_at timestamp_ntz, city string, t double",
    )


@pytest.mark.parametrize("hint", [None, "merge", "broadcast", "shuffle_hash"])
def test_kinds_of_join_agree(spark, hint):
    left, right = skewed(spark), reference_rows(spark)
    got = enrich.left_join_unique(left, right.hint(hint) if hint else right, ["recorded_at"]).collect()
    by_hour = {hours(h): float(h) for h in range(30)}
    assert len(got) == 3000 and len({r.n for r in got}) == 3000
    assert all(r.t == by_hour.get(r.recorded_at) for r in got)


def test_a_frequent_key_is_split_by_adaptive_execution(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = skewed(spark, 60_000).repartition(12).select("*", F.sha2(F.col("n").cast("string"), 256).alias("wide"))
        joined = enrich.left_join_unique(left, reference_rows(spark), ["recorded_at"])
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_join_refuses_repeated_keys(spark):
    right = reference_rows(spark).unionByName(reference_rows(spark, 1))
    with pytest.raises(KeyViolation):
        enrich.left_join_unique(skewed(spark), right, ["recorded_at"])


def test_hourly_environment_by_city(spark):
    readings = spark.createDataFrame(
        [(hours(0), "a", "NO", 1.0, "u"), (hours(0), "b", "NO", 2.0, "u"), (hours(1), "x", "NO", 3.0, "u")],
        READING + ", unit string",
    )
    measures = ", ".join(f"{m} double" for m in schemas.WEATHER_MEASURES)
    weather = spark.createDataFrame(
        [(hours(0), "P", *[1.0] * 5), (hours(0), "Q", *[2.0] * 5), (hours(1), "P", *[3.0] * 5)],
        f"recorded_at timestamp_ntz, city string, {measures}",
    )
    cities = spark.createDataFrame([("a", "P"), ("b", "Q")], "site_name string, city string")
    rows = layers.hourly_environment(readings, weather, cities).orderBy("site_name").collect()
    assert [(r.site_name, r.city, r.temperature_2m) for r in rows] == [("a", "P", 1.0), ("b", "Q", 2.0), ("x", None, None)]
    with pytest.raises(KeyViolation):
        layers.hourly_environment(readings, weather)


# ---- keys and profiles --------------------------------------------------------------------------------


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in keys.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert tuple(keys.key_summary(df, ["k"]).first()) == (4, 3, 1, 1)
    assert keys.enforce_key(df.where("k = 2"), ["k"]) == 1
    assert keys.enforce_key(df.where("k = 9"), ["k"]) == 0
    for part in ("k = 1", "k IS NULL"):
        with pytest.raises(KeyViolation):
            keys.enforce_key(df.where(part), ["k"])


def test_profiles(spark):
    df = spark.createDataFrame(
        [("1", "-1.5", "2024-01-01", "a"), ("2", "x", "2024-01-02", None), ("3", None, None, "b")],
        "i string, d string, day string, s string",
    )
    got = {r.column_name: r for r in profile.numeric_profile(df, ["i", "d", "gone"]).collect()}
    assert got.keys() == {"i", "d"}
    assert (got["d"].total_rows, got["d"].valid_readings, got["d"].missing_readings) == (3, 1, 2)
    assert (got["d"].negative_readings, got["d"].min_value, got["i"].max_value) == (1, -1.5, 3.0)
    kinds = {r.column_name: r.suggested_type for r in profile.inferred_types(df, df.columns).collect()}
    assert kinds == {"i": "BIGINT", "d": "VARCHAR", "day": "DATE", "s": "VARCHAR"}
    status = {r.column_name: r.status for r in profile.column_presence(df, ["i", "z"]).collect()}
    assert status == {"i": "OK", "z": "MISSING"}
    counts = profile.key_profile(df.unionByName(df.where("i = '1'")), ["i"], F.col("s") == "a").first()
    assert tuple(counts) == (4, 3, 1, 2)


# ---- expectations -------------------------------------------------------------------------------------


def verdicts(df, *checks):
    return [r.passed for r in expect.Suite("s", df).add(*checks).results().collect()]


def test_expectations(spark):
    df = spark.createDataFrame([(1.0, 2, "a"), (5.0, 5, "b"), (None, None, "b")], "x double, y int, s string")
    assert verdicts(
        df,
        expect.between("x", 1, 5),
        expect.between("x", low=2),
        expect.between("x", low=2, mostly=0.5),
        expect.not_null("s"),
        expect.not_null("x"),
        expect.in_set("s", ["a", "b"]),
        expect.in_set("s", ["b"]),
        expect.in_set("s", ["b"], mostly=0.6),
        expect.pair_at_least("y", "x"),
        expect.pair_at_least("x", "y"),
        expect.row_count_of_source(3),
        expect.row_count_of_source(2),
        expect.row_count_of_source(4),
        expect.match_percentage("x", 66, 67),
        expect.match_percentage("x"),
    ) == [True, False, True, True, False, True, False, True, True, False, True, False, True, True, False]


def test_wholly_missing_column_passes_bounds(spark):
    df = spark.createDataFrame([(None, "a")], "x double, s string")
    assert verdicts(df, expect.between("x", 0, 1), expect.match_percentage("x")) == [True, False]


def test_row_count_of_grid(spark):
    grid = [(a, b) for a in range(10) for b in range(10)]
    make = lambda rows: spark.createDataFrame(rows, "a int, b int")
    check = expect.row_count_of_grid(["a", "b"])
    assert verdicts(make(grid), check) == [True]
    assert verdicts(make(grid[:-5]), check) == [True]
    assert verdicts(make(grid[:-6]), check) == [False]
    assert verdicts(make([*grid, grid[0]]), check) == [False]


def test_gate_measures_every_suite_before_it_fails(spark):
    df = spark.range(3).toDF("x")
    bad = expect.Suite("one", df).add(expect.between("x", 1, 2))
    worse = expect.Suite("two", df).add(expect.between("x", 5, 6), expect.not_null("x"))
    with pytest.raises(QualityGateFailed) as problem:
        expect.gate([bad, worse])
    assert "one.between" in str(problem.value) and "two.between" in str(problem.value)
    fine = expect.Suite("three", df).add(expect.not_null("x"))
    assert [r.passed for r in expect.gate([fine])] == [True]


def test_a_suite_scans_its_table_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    suite = expect.Suite("s", df).add(
        expect.row_count_of_grid(["l_returnflag", "l_linestatus"]), expect.not_null("l_tax"), expect.between("l_tax", 0)
    )
    assert suite.results()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# ---- writing and serving --------------------------------------------------------------------------------

COLUMNS = {"day": "date", "site": "string", "value": "double", "year": "int", "month": "int"}


def rows(spark, *items):
    days = [(dt.date(2024, m, d), s, v, 2024, m) for m, d, s, v in items]
    return spark.createDataFrame(days, ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))


def publish(df, path):
    return serving.publish(df, path, COLUMNS, ("day", "site"), ("year", "month"), ("site",))


def content(spark, path):
    return {(r.day.month, r.day.day, r.site): r.value for r in serving.read_table(spark, path, COLUMNS).collect()}


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_publish(spark, tmp_path):
    path = str(tmp_path / "table")
    assert content(spark, path) == {}
    assert publish(rows(spark), path) == 0 and content(spark, path) == {}
    assert publish(rows(spark, (1, 1, "a", 1.0), (1, 2, "a", 2.0), (2, 1, "a", 3.0)), path) == 2
    first = content(spark, path)
    assert first == {(1, 1, "a"): 1.0, (1, 2, "a"): 2.0, (2, 1, "a"): 3.0}
    february = {name: at for name, at in files_of(path).items() if "month=2" in name}
    # an update may set NULL, other keys stay, nothing is deleted, February is not rewritten
    assert publish(rows(spark, (1, 2, "a", None), (1, 3, "b", 9.0)), path) == 1
    assert content(spark, path) == {**first, (1, 2, "a"): None, (1, 3, "b"): 9.0}
    assert february and february.items() <= files_of(path).items()
    before = content(spark, path)
    publish(rows(spark, (1, 2, "a", None), (1, 3, "b", 9.0)), path)
    assert content(spark, path) == before


def test_the_first_publish_writes_no_merged_copy(spark, tmp_path, monkeypatch):
    path, merged = str(tmp_path / "t"), []
    monkeypatch.setattr(serving, "stored", lambda df, purpose: merged.append(purpose) or stored(df, purpose))
    assert publish(rows(spark, (1, 1, "a", 1.0), (2, 1, "a", 3.0)), path) == 2 and not merged
    first = content(spark, path)
    assert publish(rows(spark, (1, 1, "a", 1.0)), path) == 1 and merged == ["merged"]
    assert content(spark, path) == first and len(first) == 2


def test_publish_refuses_a_broken_key_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(rows(spark, (1, 1, "a", 1.0)), path)
    for bad in (rows(spark, (1, 1, "a", 2.0), (1, 1, "a", 3.0)), rows(spark, (1, 1, None, 2.0))):
        with pytest.raises(KeyViolation):
            publish(bad, path)
    assert content(spark, path) == {(1, 1, "a"): 1.0}


def test_a_publish_that_stopped_is_run_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    publish(rows(spark, (1, 1, "a", 1.0), (2, 1, "a", 2.0)), path)
    changes = rows(spark, (1, 1, "a", 5.0), (2, 2, "b", 6.0))

    def half(merged, path, *rest, **named):
        layout.replace_partitions(merged.where("month = 1"), path, *rest, **named)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(serving, "replace_partitions", half)
        with pytest.raises(RuntimeError):
            publish(changes, path)
    publish(changes, path)
    assert content(spark, path) == {(1, 1, "a"): 5.0, (2, 1, "a"): 2.0, (2, 2, "b"): 6.0}


def test_lookups_skip_row_groups(spark, tmp_path):
    """The filter is in the file, and a look-up reads fewer rows than the file holds."""
    path = str(tmp_path / "table")
    columns = {"day": "date", "site": "string", "value": "double", "year": "int"}
    some = spark.range(40_000).selectExpr(
        "date_add(date'2024-01-01', cast(id % 366 as int)) AS day", "concat('s', hash(id) % 1000000 * 2) AS site", "id / 2 AS value", "2024 AS year"
    )
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 20_000)
    try:
        serving.publish(some.coalesce(1), path, columns, ("day", "site"), ("year",), ("day",), ("site",))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    (file,) = pathlib.Path(path).rglob("*.parquet")
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsc.hadoopConfiguration()
    )
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    blocks = footer.getFooter().getBlocks()
    chunks = {c.getPath().toDotString(): c for c in blocks.get(0).getColumns()}
    assert blocks.size() > 3
    assert chunks["site"].getBloomFilterOffset() > 0 and chunks["value"].getBloomFilterOffset() < 0
    assert chunks["day"].getColumnIndexReference() is not None
    footer.close()

    def scanned(condition):
        found = serving.read_table(spark, path, columns).where(condition)
        rows = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(rows), leaf.metrics().apply("numOutputRows").value()

    assert scanned("site = 's3'") == (0, 0)  # between the least and greatest site, but in no filter
    # (columns of few values are kept as a dictionary, which Parquet asks in place of a filter)
    found, read = scanned("day = date'2024-03-01'")
    assert found > 100 and read < 20_000


change = st.tuples(st.integers(1, 6), st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 9)))


@settings(max_examples=6, deadline=None)
@given(st.lists(change, max_size=12), st.lists(change, max_size=12))
def test_upsert_is_last_writer_wins(spark, old, new):
    schema = "k int, s string, v int"
    target = {(k, s): v for k, s, v in old}
    changes = {(k, s): v for k, s, v in new}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], schema)
    once = serving.upsert(frame(target), frame(changes), ["k", "s"])
    twice = serving.upsert(once, frame(changes), ["k", "s"])
    want = sorted((k, s, -1 if v is None else v) for (k, s), v in {**target, **changes}.items())
    for result in (once, twice):
        assert sorted((r.k, r.s, -1 if r.v is None else r.v) for r in result.collect()) == want


def test_staging_casts_and_refuses_overflow(spark):
    df = spark.createDataFrame([(2**40, "x", 1)], "year bigint, site string, extra int")
    assert layout.as_table(df.withColumn("year", F.lit(2024)), {"site": "string", "year": "int"}).dtypes == [
        ("site", "string"),
        ("year", "int"),
    ]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        layout.as_table(df, {"year": "int"}).collect()


def test_replace_partitions_counts_on_the_way_out(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 2).alias("y"))
    counts = {"rows": F.count(F.lit(1)), "high": F.max("id")}
    assert layout.replace_partitions(df, path, ["y"], ["id"], counts) == {"rows": 100, "high": 99}
    layout.replace_partitions(spark.createDataFrame([(7, 1)], "id bigint, y bigint"), path, ["y"])
    back = spark.read.parquet(path)
    assert back.where("y = 0").count() == 50
    assert [r.id for r in back.where("y = 1").collect()] == [7]
    scan = back.where("y = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in scan


def test_emptied_partitions_in_scope_go(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(90).select("id", (F.col("id") % 3).alias("y"), (F.col("id") % 2).alias("m"))
    layout.replace_partitions(df, path, ["y", "m"])
    redelivered = df.where("y = 0 AND m = 1").withColumn("id", F.col("id") + 1000)
    layout.replace_partitions(redelivered, path, ["y", "m"], scope=lambda folder: folder["y"] in ("0", "1"))
    left = {(r.y, r.m): r.n for r in spark.read.parquet(path).groupBy("y", "m").agg(F.count("id").alias("n")).collect()}
    assert left == {(0, 1): 15, (2, 0): 15, (2, 1): 15}


def test_sorted_files_are_in_global_order(spark):
    df = layout.sorted_files(spark.range(0, 5000).select(F.xxhash64("id").alias("h"), "id"), ["h", "id"])
    parts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.min("h"), F.max("h")).orderBy("p").collect()
    assert all(a[2] <= b[1] for a, b in zip(parts, parts[1:]))


def test_export_marks_null_and_keeps_empty_text(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a,b"), (2, 2.5, ""), (3, 0.0, 'say "x"')], "i int, v double, s string")
    layout.export_csv(df.coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.csv")
    assert file.read_text().splitlines() == ["1,\\N,\"a,b\"", '2,2.5,""', '3,0.0,"say ""x"""']


# ---- refresh scope ----------------------------------------------------------------------------------------


def test_touched_months_and_spans():
    assert layers.touched_months([2025])[-2:] == [(2025, 12), (2026, 1)]
    assert len(layers.touched_months([2025, 2026])) == 25
    assert layers.touched_months([2025], ("year",))[-1] == (2026, 12)
    assert layers.month_spans(layers.touched_months([2025, 2022])) == [
        (dt.date(2022, 1, 1), dt.date(2023, 2, 1)),
        (dt.date(2025, 1, 1), dt.date(2026, 2, 1)),
    ]


def test_rows_of_months_reads_no_other_years(spark, tmp_path):
    path = str(tmp_path / "silver")
    day = F.lit("2022-01-01").cast("date").cast("timestamp_ntz")
    rows = spark.range(365 * 4).select(
        (day + F.make_dt_interval(F.col("id").cast("int"))).alias("recorded_at"),
        (F.lit(2022) + F.floor(F.col("id") / 365)).cast("int").alias("source_year"),
    )
    rows.write.partitionBy("source_year").parquet(path)
    some = layers.rows_of_months(spark.read.parquet(path), layers.touched_months([2024]))
    found = some.agg(F.min("recorded_at"), F.max("recorded_at"), F.count("*")).first()
    assert tuple(found) == (dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 31), 366 + 31)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "source_year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(recorded_at" in plan


def test_each_date_pattern_stands_once_in_the_silver_plan(spark):
    columns = ", ".join(f"`{c}` string" for c in ("Date", "time", *schemas.MEASURES))
    bronze = spark.createDataFrame([], f"{columns}, site_name string, source_year int, source_file string")
    plan = layers.silver_readings(bronze)._jdf.queryExecution().optimizedPlan().toString()
    for pattern in (clock._DAY_FIRST, clock._ISO_WITH_TIME):
        assert plan.count(pattern) == 1


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    hours = spark.range(4_000).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id % 800)) AS recorded_at", "id", "id % 7 AS site")
    weather = hours.select("recorded_at").distinct().withColumn("temperature", F.hour("recorded_at"))
    left = colocated.bucketed(hours, ["recorded_at"], 4)
    right = colocated.bucketed(weather.limit(700), ["recorded_at"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a weather table too large for it
    try:
        joined = enrich.left_join_unique(left, right, ["recorded_at"], unique=True)
        got = sorted(map(tuple, joined.select("id", "temperature").collect()))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = enrich.left_join_unique(hours, right, ["recorded_at"], unique=True)
    assert got == sorted(map(tuple, plain.select("id", "temperature").collect()))


def test_file_ranges(spark, tmp_path):
    rows = spark.range(5_000).selectExpr("id * 7919 % 5000 AS a", "id AS b", "id % 3 AS c")
    layout.sorted_files(rows, ["c", "a"]).write.parquet(str(tmp_path / "sorted"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.sorted_files(rows, ["c", "a"]).write.parquet(str(tmp_path / "many"))
        rows.repartition(4).write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = {n: layout.file_ranges(spark.read.parquet(str(tmp_path / n)), ["c", "a"]).collect() for n in ("many", "mixed")}
    assert len(ranges["many"]) > 1 and all(r.follows for r in ranges["many"])
    assert sum(r.rows for r in ranges["many"]) == 5_000
    assert not all(r.follows for r in ranges["mixed"])


@pytest.mark.parametrize("skip, unmet", [("both", 3), ("either", 1), ("never", 4)])
def test_pairs_with_nulls(spark, skip, unmet):
    table = spark.createDataFrame([(2, 1), (1, 2), (None, 1), (1, None), (None, None)], "x int, y int")
    suite = expect.Suite("pairs", table).add(expect.pair_at_least("x", "y", skip_null=skip))
    (row,) = suite.results().collect()
    assert (row.passed, int(row.observed)) == (False, unmet)
    with pytest.raises(ValueError):
        expect.pair_at_least("x", "y", skip_null="some")


def test_scratch_without_the_setting(tmp_path):
    def session(master, folder=None):
        context = SimpleNamespace(master=master, applicationId=f"app of {master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    here = session("local[2]")
    one, two = scratch_dir(here, "a"), scratch_dir(here, "b")
    assert one != two and one.split("/stationlake/")[0] == two.split("/stationlake/")[0]
    assert scratch_dir(session("yarn", str(tmp_path)), "a").startswith(str(tmp_path))
    with pytest.raises(RuntimeError):
        scratch_dir(session("yarn"), "a")
