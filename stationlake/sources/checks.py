"""Validation of landed files, one output row per file.

A station file is judged by aggregates over its lines, so a large one is split over tasks. A file above
``max_bytes`` is reported as ``too_large``, with its digest, header and counts as any other; None sets
no limit. A weather document is one JSON object and is read as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.clock import parse_date
from stationlake.functions.fingerprint import canonical_json
from stationlake.session import stored
from stationlake.sources.files import file_listing, payloads, plain_path
from stationlake.sources.lines import FILLED, cells, decoded, file_digests, file_heads, file_lines, text_scan

def _too_large(max_bytes: int | None) -> Column:
    return F.lit(False) if max_bytes is None else F.col("length") > max_bytes


def weather_digests(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    """path, source_year, length, sha256 of weather documents, without the volatile key."""
    files = payloads(spark, folders, pattern)
    text = F.col("content").cast("string")
    digest = F.sha2(canonical_json(text, [schemas.VOLATILE_JSON_KEY]), 256)
    return files.select("path", "source_year", "length", digest.alias("sha256"))


def _first_problem(**checks: Column) -> Column:
    """Name of the first check that holds, NULL when none does."""
    return F.coalesce(*[F.when(found, F.lit(name)) for name, found in checks.items()])


def _settled(report: DataFrame) -> DataFrame:
    """The same rows behind a generator. Without it a later filter, say on ``problem``, is pushed
    down to the payloads, and every check in it parses the whole payload once more."""
    return report.select(F.inline(F.array(F.struct(*report.columns))))


def csv_report(
    listed: DataFrame,
    lines: DataFrame,
    max_bytes: int | None = schemas.CSV_MAX_BYTES,
    first_line: str = schemas.CSV_FIRST_LINE,
    preamble_lines: int = schemas.CSV_PREAMBLE_LINES,
    required: Sequence[str] = schemas.CSV_REQUIRED,
    date_column: str = schemas.DATE_COLUMN,
) -> DataFrame:
    """Check the files ``listed`` (path, length, source_year and any other column) by their ``lines``
    (uri, at, line; see ``file_lines``).

    Output: the columns of ``listed``, uri, encoding, header, header_line, preamble, row_count, latest_date,
    bad_dates, wrong_year, short_rows and ``problem`` (NULL when the file is accepted). One scan finds
    the heads, a second one judges the rows of files that look like station files by their head; both
    only aggregate numbers by file.
    """
    missing = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("header"))
    heads = (
        file_heads(lines, preamble_lines)
        .withColumn("announced", F.coalesce(F.col("opening").startswith(first_line), F.lit(False)))
        .withColumn("header", F.when(F.col("announced"), cells(F.col("header_line"))))
        .withColumn("date_at", F.array_position("header", date_column).cast("int"))
    )
    years = listed.select(plain_path(F.col("path")).alias("path"), "source_year", "length")
    heads = years.join(heads, "path", "left").withColumn(
        "problem",
        _first_problem(
            empty=F.col("length") == 0,
            html=F.col("first_text").rlike(r"(?i)^\s*<(!doctype html|html)"),
            no_data_rows=F.coalesce("line_count", F.lit(0)) <= preamble_lines + 1,
            preamble=~F.col("announced"),
            missing_columns=F.coalesce(F.size(missing), F.lit(1)) > 0,
        ),
    )
    heads = stored(heads, "file-heads")  # one row a file

    # Only lines of files that look like station files so far are taken apart.
    line, date_at = F.col("line"), F.col("date_at")
    opened = heads.where("problem IS NULL").select("uri", "path", "source_year", "header_line", "preamble", "date_at", "utf8")
    body = lines.where(line.rlike(FILLED)).join(opened, "uri").withColumn("line", decoded(line, F.col("utf8")))
    body = body.where((line != F.col("header_line")) & ~F.array_contains("preamble", line))
    first_cells = body.select("path", "source_year", "date_at", cells(line, date_at + 1).alias("cells"))
    date = parse_date(F.try_element_at("cells", date_at), day_first_only=True)
    dated = first_cells.select("path", "source_year", "date_at", F.size("cells").alias("filled"), date.alias("date"))
    counts = dated.groupBy("path").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max("date").alias("latest_date"),
        F.count_if(F.col("date").isNull()).alias("bad_dates"),
        F.count_if(F.year("date") != F.col("source_year")).alias("wrong_year"),
        F.count_if(F.col("filled") < date_at).alias("short_rows"),
    )
    columns = ["row_count", "bad_dates", "wrong_year", "short_rows"]
    judged = heads.select("path", "uri", "utf8", "header", "header_line", "preamble", "problem").join(counts, "path", "left")
    # A file without rows counts 0 of them; one whose rows were not looked at has no counts.
    judged = judged.withColumns({c: F.when(F.col("problem").isNull(), F.coalesce(c, F.lit(0))) for c in columns})
    judged = judged.withColumnRenamed("path", "key")
    report = listed.join(judged, plain_path(F.col("path")) == F.col("key")).withColumn(
        "problem",
        F.coalesce(
            "problem",
            _first_problem(
                short_row=F.col("short_rows") > 0,
                bad_date=F.col("bad_dates") > 0,
                wrong_year=F.col("wrong_year") > 0,
                no_valid_rows=F.col("row_count") == 0,
                too_large=_too_large(max_bytes),
            ),
        ),
    )
    return report.select(
        *(F.col(f"`{c}`") for c in listed.columns),
        "uri",
        F.when(F.coalesce("utf8", F.lit(True)), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        "header",
        "header_line",
        "preamble",
        "row_count",
        "latest_date",
        "bad_dates",
        "wrong_year",
        "short_rows",
        "problem",
    )


def listed_with_digests(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    """path, source_year, length, sha256 of the station files, whatever their size."""
    listing = file_listing(spark, folders, pattern).select("path", "source_year", "length")
    return _with_digests(listing, file_digests(spark, folders, pattern))


def _with_digests(files: DataFrame, digests: DataFrame) -> DataFrame:
    digests = digests.withColumnRenamed("path", "key")
    joined = files.join(digests, plain_path(F.col("path")) == F.col("key"), "left").drop("key")
    return joined.withColumn("sha256", F.coalesce("sha256", F.sha2(F.lit(b""), 256)))  # an empty file has no lines


def station_report(
    spark: SparkSession,
    folders: str | Sequence[str],
    pattern: str,
    max_bytes: int | None = schemas.CSV_MAX_BYTES,
    listing: DataFrame | None = None,
    scan: DataFrame | None = None,
) -> DataFrame:
    """``csv_report`` of the files below some folders, with their SHA-256; both are stages of one job.

    ``listing`` (``file_listing``) and ``scan`` (``text_scan``) of these folders may be handed in: the
    folders are then not listed again.
    """
    listing = file_listing(spark, folders, pattern) if listing is None else listing
    listing = listing.select("path", "source_year", "length")
    scan = text_scan(spark, folders, pattern) if scan is None else scan
    report = csv_report(listing, file_lines(spark, folders, pattern, scan), max_bytes)
    return _with_digests(report, file_digests(spark, folders, pattern, scan))


def weather_report(files: DataFrame, max_bytes: int | None = schemas.JSON_MAX_BYTES) -> DataFrame:
    """Check weather documents (path, length, content, source_year).

    The digest is taken of the canonical text without the volatile key, so a re-delivery that only
    differs in request timing counts as unchanged. Output: path, source_year, length, sha256,
    row_count, first_timestamp, latest_timestamp, problem.
    """
    text = F.col("content").cast("string")
    read = files.select(
        "path",
        "source_year",
        "length",
        F.sha2(canonical_json(text, [schemas.VOLATILE_JSON_KEY]), 256).alias("sha256"),
        F.from_json(text, schemas.WEATHER_DOCUMENT).getField("hourly").alias("hourly"),
    )
    judged = weather_problems(read).drop("hourly")
    too_large = F.when(_too_large(max_bytes), "too_large")
    return _settled(judged.withColumn("problem", F.coalesce("problem", too_large)))


def weather_problems(documents: DataFrame) -> DataFrame:
    """Add row_count, first/latest timestamp and ``problem`` to rows holding ``hourly`` and
    ``source_year``. This must run before the arrays are zipped: zipping pads short arrays."""
    size = lambda name: F.size(F.col(f"hourly.{name}"))
    times = F.col("hourly.time")
    absent = F.lit(False)
    uneven = F.lit(False)
    for name in schemas.WEATHER_ARRAYS:
        absent = absent | F.col(f"hourly.{name}").isNull()
        uneven = uneven | (size(name) != size("time"))
    expected = F.concat(F.col("source_year").cast("string"), F.lit("-"))
    return (
        documents.withColumn("row_count", F.size(times).cast("bigint"))
        .withColumn("first_timestamp", F.try_element_at(times, F.lit(1)))
        .withColumn("latest_timestamp", F.try_element_at(times, F.lit(-1)))
        .withColumn(
            "problem",
            _first_problem(
                no_hourly=F.col("hourly").isNull(),
                missing_fields=absent,
                no_rows=F.size(times) == 0,
                length_mismatch=uneven,
                starts_in_other_year=~F.col("first_timestamp").startswith(expected),
                ends_in_other_year=~F.col("latest_timestamp").startswith(expected),
            ),
        )
    )
