"""Change detection and refresh scope. ``as_of`` is always given: nothing reads the wall clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.errors import BadRequestedYears

MAX_REQUESTED_YEARS = 10


def is_recent(year: Column, as_of_year: int, window: int = 2) -> Column:
    """True for the last ``window`` years up to ``as_of_year``; a file without a year is not recent."""
    return F.coalesce(year > as_of_year - window, F.lit(False))


def sync_plan(listing: DataFrame, copies: DataFrame, as_of_year: int) -> DataFrame:
    """What to fetch: ``listing`` (path, length, source_year) against ``copies`` (path, length).

    Old files are skipped when their size is unchanged. Recent ones are always fetched, as a
    revision may keep the size.
    """
    have = copies.select("path", F.col("length").alias("copy_length"))
    same = F.coalesce(F.col("length") == F.col("copy_length"), F.lit(False))
    recent = is_recent(F.col("source_year"), as_of_year)
    return (
        listing.join(have, "path", "left")
        .withColumn("recent", recent)
        .withColumn("same_size", same)
        .withColumn("action", F.when(~recent & same, "skip").otherwise("fetch"))
        .drop("copy_length")
    )


def landing_plan(
    delivered: DataFrame,
    landed: DataFrame,
    latest_year: int | None = None,
    window: int = 2,
) -> DataFrame:
    """Status per delivered file: ``unchanged`` when the SHA-256 is known, else ``uploaded``.

    With ``latest_year`` given, a year older than the window that already carries a checksum is
    ``frozen`` and keeps its landed state whatever was delivered.
    """
    known = landed.select("path", F.col("sha256").alias("landed_sha256"))
    status = F.when(F.col("sha256") == F.col("landed_sha256"), "unchanged").otherwise("uploaded")
    if latest_year is not None:
        frozen = ~is_recent(F.col("source_year"), latest_year, window)
        status = F.when(frozen & F.col("landed_sha256").isNotNull(), "frozen").otherwise(status)
    return delivered.join(known, "path", "left").withColumn("status", status)


def landing_path(prefix: str, source: str, year: int, name: str) -> str:
    """Folder layout of the raw zone: one file per source and year."""
    return "/".join((prefix.strip("/"), source, f"year={year}", name))


def mirrored_path(key: str, key_root: str, copy_root: str) -> str:
    """Where the copy of ``key`` belongs below ``copy_root``."""
    return f"{copy_root.rstrip('/')}/{key.removeprefix(key_root.rstrip('/') + '/')}"


def refresh_years(as_of: dt.date, count: int = 2) -> list[int]:
    """The years that may still be revised, newest first."""
    return [as_of.year - back for back in range(count)]


def available_through(as_of: dt.date, lag_days: int) -> dt.date:
    """Last day a lagging source has published."""
    return as_of - dt.timedelta(days=lag_days)


def backfill_years(start: dt.date, as_of: dt.date, lag_days: int) -> list[int]:
    """All years a lagging source can deliver, oldest first."""
    return list(range(start.year, available_through(as_of, lag_days).year + 1))


def requested_years(values: Iterable[object], first: int, last: int) -> list[int]:
    """Check an explicit request: 1 to 10 whole numbers between ``first`` and ``last``.

    Repeats are dropped; the first occurrence keeps its place.
    """
    if not isinstance(values, (list, tuple)) or not 0 < len(values) <= MAX_REQUESTED_YEARS:
        raise BadRequestedYears(f"give a list of 1 to {MAX_REQUESTED_YEARS} years")
    years: dict[int, None] = {}
    for value in values:
        number = None if isinstance(value, bool) else _whole_number(value)
        if number is None or number not in range(first, last + 1):
            raise BadRequestedYears(f"{value!r} is not a year from {first} to {last}")
        years.setdefault(number)
    return list(years)


def _whole_number(value: object) -> int | None:
    try:
        return int(value)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return None


def years_frame(spark: SparkSession, years: Sequence[int]) -> DataFrame:
    """The requested years as rows; ``position`` keeps their order."""
    rows = list(enumerate(years))
    return spark.createDataFrame(rows, "position int, source_year int")


def year_bounds(years: DataFrame, start: dt.date, as_of: dt.date, lag_days: int) -> DataFrame:
    """First and last day to request per ``source_year``; years without such a day drop out."""
    year = F.col("source_year")
    through = F.lit(available_through(as_of, lag_days))
    bounded = years.withColumn(
        "first_day", F.greatest(F.lit(start), F.make_date(year, F.lit(1), F.lit(1)))
    ).withColumn("last_day", F.least(through, F.make_date(year, F.lit(12), F.lit(31))))
    return bounded.where(F.col("last_day") >= F.col("first_day"))
