"""Listing of raw files. Only file metadata is read here, never content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.errors import MissingInputError
from stationlake.session import few_listing_tasks, path_exists


def year_in_path(path: Column) -> Column:
    """The year of a ``.../year=YYYY/...`` or ``.../source_year=YYYY/...`` folder, else NULL."""
    return F.regexp_extract(path, r"year=(\d{4})/", 1).try_cast("int")


def site_in_path(path: Column) -> Column:
    """The site of a ``.../site=S/...`` folder with its URI escapes undone, else NULL."""
    return F.nullif(plain_path(F.regexp_extract(path, r"/site=([^/]+)/", 1)), F.lit(""))


def plain_path(path: Column) -> Column:
    """One spelling of a path, however the reader that named it writes slashes and escapes."""
    unescaped = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(unescaped, path), r"^(\w+):/+", "$1:/")


def any_case(pattern: str) -> str:
    """The file pattern with every letter in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in pattern)


def _binary_files(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    with few_listing_tasks(spark):
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", any_case(pattern))
            .option("recursiveFileLookup", "true")
            .load([folders] if isinstance(folders, str) else list(folders))
        )


def file_listing(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    """One row per file below the folders: path, length, modified_at, source_year.

    Spark's readers pass over files without bytes. They are taken from its file index, which the
    driver holds anyway; when they were modified is not known there.
    """
    found = _binary_files(spark, folders, pattern)
    listed = found.select("path", "length", F.col("modificationTime").alias("modified_at"))
    indexed = spark.createDataFrame([(path,) for path in found.inputFiles()], "path string")
    key = plain_path(F.col("path"))
    empty = indexed.select(key.alias("path")).join(listed.select(key.alias("path")), "path", "left_anti")
    empty = empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified_at"))
    return listed.unionByName(empty).withColumn("source_year", year_in_path(F.col("path")))


def require_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``file_listing``, or ``MissingInputError`` when there is none."""
    if not path_exists(spark, root):
        raise MissingInputError(f"no folder {root}")
    listing = file_listing(spark, root, pattern)
    if listing.isEmpty():
        raise MissingInputError(f"no {pattern} below {root}")
    return listing


def year_folders(spark: SparkSession, root: str, years: Sequence[int] | None) -> list[str]:
    """``root``, or those of its ``source_year=Y`` and ``year=Y`` folders for ``years`` that exist. A
    lagging source may not have begun the newest year."""
    root = root.rstrip("/")
    if years is None:
        return [root]
    folders = [f"{root}/{name}={y}" for y in years for name in ("source_year", "year")]
    return [f for f in folders if path_exists(spark, f)]


def payloads(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    """path, length, content and source_year per file: for documents that only make sense as a whole."""
    files = _binary_files(spark, folders, pattern)
    return files.select(
        "path", "length", "content", year_in_path(F.col("path")).alias("source_year")
    )
