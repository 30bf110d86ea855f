"""Reader for yearly station CSV files: preamble, header, data; layouts differ between files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.errors import MissingInputError
from stationlake.functions.cells import blank_tokens_to_null, is_nonblank
from stationlake.sources.files import plain_path, site_in_path, year_in_path
from stationlake.sources.lines import cells, decoded, file_lines

CORRUPT = "_corrupt"


def unique_names(header: Sequence[str]) -> list[str]:
    """Repeated header names get ``_1``, ``_2``, ... in order of appearance, ignoring case."""
    seen: dict[str, int] = {}
    names = []
    for name in header:
        count = seen.get(name.lower(), 0)
        seen[name.lower()] = count + 1
        names.append(name if count == 0 else f"{name}_{count}")
    return names


def read_station_csv(
    spark: SparkSession,
    report: DataFrame,
    folders: str | Sequence[str],
    pattern: str = "*",
    accepted_only: bool = True,
    lines: DataFrame | None = None,
) -> DataFrame:
    """All rows of the accepted files in ``report`` (from ``csv_report``), cells as text.

    The lines of all files are one scan, whatever the number of layouts. Each line meets the places
    that its file's header gives to the columns of the result, which are those of all headers. Only
    the distinct headers reach the driver. Lines of the wrong number of cells are in ``CORRUPT``; the
    head of a file is left out; see ``classified_rows`` for the rest. ``source_year`` and ``site``
    (NULL without such a folder) are taken from the path. ``lines`` may hand in lines already read.
    """
    used = report.where("problem IS NULL") if accepted_only else report
    used = used.where(F.col("header").isNotNull())
    headers = [tuple(r.header) for r in used.select("header").distinct().orderBy("header").collect()]
    if not headers:
        raise MissingInputError(f"no accepted CSV file below {folders}")
    named = {header: unique_names(header) for header in headers}
    columns = list(dict.fromkeys(name for names in named.values() for name in names))
    places = [(list(h), len(n), [n.index(c) if c in n else -1 for c in columns]) for h, n in named.items()]
    layouts = spark.createDataFrame(places, "header array<string>, width int, places array<int>")
    uri, line = F.col("uri"), F.col("line")
    files = used.join(F.broadcast(layouts), "header").select(
        "uri",
        "header_line",
        "preamble",
        (F.col("encoding") == "UTF-8").alias("utf8"),
        "width",
        "places",
        F.substring_index(plain_path(uri), "/", -1).alias("source_file"),
        year_in_path(uri).alias("source_year"),
        site_in_path(uri).alias("site"),
    )
    lines = file_lines(spark, folders, pattern) if lines is None else lines
    joined = lines.join(files, "uri")
    joined = joined.withColumn("line", decoded(line, F.col("utf8"))).where(
        (line != F.col("header_line")) & ~F.array_contains("preamble", line)
    )
    parted = joined.withColumn("cells", cells(line))
    return parted.select(
        *[F.get("cells", F.get("places", F.lit(k))).alias(name) for k, name in enumerate(columns)],
        F.when(F.size("cells") != F.col("width"), line).alias(CORRUPT),
        "source_file",
        uri.alias("source_path"),
        "source_year",
        "site",
    )


def _is_preamble(first_cell: Column, starts: Sequence[str]) -> Column:
    hit = first_cell == F.lit(schemas.DATE_COLUMN)
    for start in starts:
        hit = hit | first_cell.startswith(start)
    return F.coalesce(hit, F.lit(False))


# How the lines above the header begin; the header itself begins with "Date".
PREAMBLE_STARTS = (schemas.CSV_FIRST_LINE, "All Data GMT", "Status:")


def classified_rows(
    rows: DataFrame, preamble_starts: Sequence[str] = PREAMBLE_STARTS
) -> DataFrame:
    """``rows`` with missing-value tokens as NULL, and their ``kind``:

    * ``data``: well-formed and with a date;
    * ``malformed``: too few or too many cells. The lines of the preamble are of this kind too.

    Blank lines, the header and rows without a date drop out. Writing both kinds with ``kind`` as a
    partition column keeps the malformed lines without parsing the files a second time.
    """
    lineage = {CORRUPT, "source_file", "source_path", "source_year", "site"}
    cleaned = rows.select(
        [
            F.col(f"`{c}`") if c in lineage else blank_tokens_to_null(F.col(f"`{c}`")).alias(c)
            for c in rows.columns
        ]
    )
    date, line = F.col(schemas.DATE_COLUMN), F.col(CORRUPT)
    kind = F.when(
        line.isNull() & is_nonblank(date) & ~_is_preamble(date, preamble_starts), "data"
    ).when(line.rlike(r'[^,"\s]'), "malformed")
    return cleaned.withColumn("kind", kind).where(F.col("kind").isNotNull())


def data_rows(classified: DataFrame) -> DataFrame:
    """The well-formed rows of ``classified_rows``."""
    return classified.where(F.col("kind") == "data").drop("kind", CORRUPT, "source_path")


def malformed_rows(classified: DataFrame, report: DataFrame) -> DataFrame:
    """The malformed lines of ``classified_rows`` as delivered: path, source_file, line.

    The preamble is left out by comparison with the lines in ``report``.
    """
    broken = classified.where(F.col("kind") == "malformed")
    preambles = report.select(
        plain_path(F.col("path")).alias("path"), F.explode("preamble").alias("line")
    ).distinct()
    return broken.select(
        plain_path(F.col("source_path")).alias("path"), "source_file", F.col(CORRUPT).alias("line")
    ).join(preambles, ["path", "line"], "left_anti")
