"""Text files line by line: large ones are split over tasks, and no row or driver list holds a file."""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import few_listing_tasks
from stationlake.sources.files import any_case, plain_path

#: A line with a cell that is a date. All others may belong to the head of a file.
_DATE_CELL = r'(^|,)\s*"?\d{1,4}[-/]\d{1,2}[-/]\d{1,4}"?\s*(,|$)'
#: What a line holds besides separators, quotes and white space.
FILLED = r'[^,"\s]'


def text_scan(spark: SparkSession, folders: str | Sequence[str], pattern: str) -> DataFrame:
    """The files as text. The folders are listed here: hand one scan to all that read the same files."""
    with few_listing_tasks(spark):
        return (
            spark.read.option("pathGlobFilter", any_case(pattern))
            .option("recursiveFileLookup", "true")
            .option("lineSep", "\n")
            .text([folders] if isinstance(folders, str) else list(folders))
        )


def file_lines(
    spark: SparkSession, folders: str | Sequence[str], pattern: str, scan: DataFrame | None = None
) -> DataFrame:
    """uri, at, line: every line of the files. ``at`` numbers the lines of a file's first block, one by
    one from any start, and is NULL beyond it; ``uri`` is the path as the reader spells it."""
    first_block = F.col("_metadata.file_block_start") == 0
    scan = text_scan(spark, folders, pattern) if scan is None else scan
    return scan.select(
        F.col("_metadata.file_path").alias("uri"),
        F.when(first_block, F.monotonically_increasing_id()).alias("at"),
        F.rtrim(F.ltrim("value", F.lit("﻿")), F.lit("\r")).alias("line"),
    )


def file_digests(
    spark: SparkSession, folders: str | Sequence[str], pattern: str, scan: DataFrame | None = None
) -> DataFrame:
    """path, sha256 of every file that is not empty, equal to the digest of its bytes.

    SHA-256 takes bytes in order, so the lines of a file come to one task, sorted by block and place,
    and are digested as they stream by. However large the file, a task holds one batch of lines.
    """
    scan = text_scan(spark, folders, pattern) if scan is None else scan
    lines = scan.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("line"),
    )
    ordered = lines.repartition("uri").sortWithinPartitions("uri", "block", "place")
    found = ordered.select("uri", "size", "line").mapInArrow(_digested, "uri string, sha256 string")
    return found.select(plain_path(F.col("uri")).alias("path"), "sha256")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of equal uris: the digest of the lines, joined by line ends.

    The reader drops a byte order mark in front of a file and does not tell whether the last line
    ends. Both follow from the bytes that are missing at the end; until then two digests are kept.
    """
    uri, size, done, digests = None, 0, 0, ()

    def add(part: bytes) -> None:
        for digest in digests:
            digest.update(part)

    def closed() -> pa.RecordBatch:
        missing = size - done
        if missing in (1, 4):
            add(b"\n")
        return pa.RecordBatch.from_pydict({"uri": [uri], "sha256": [digests[missing > 1].hexdigest()]})

    for batch in batches:
        runs = pc.run_end_encode(batch.column(0))
        start = 0
        for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
            if name != uri:
                if uri is not None:
                    yield closed()
                uri, size, done = name, batch.column(1)[start].as_py(), 0
                digests = hashlib.sha256(), hashlib.sha256(codecs.BOM_UTF8)
            else:
                add(b"\n")
                done += 1
            part = b"\n".join(batch.column(2).slice(start, end - start).to_pylist())
            add(part)
            done += len(part)
            start = end
    if uri is not None:
        yield closed()


def file_heads(lines: DataFrame, preamble_lines: int) -> DataFrame:
    """One row per file of ``lines`` (uri, at, line): line_count, utf8, ``opening`` (the first line),
    ``first_text`` (the first that is not blank), ``header_line`` and ``preamble``.

    Lines that look like data are only counted. The others are counted by their text, so the
    aggregates hold numbers alone and sum up where the lines are read. Lines of a file's first block
    are numbered one by one; of each remainder modulo the lines of a head, the smallest number among
    the lines left is the only one that can be in the head.
    """
    filled = F.col("line").rlike(FILLED)
    text = F.when(filled & ~F.col("line").rlike(_DATE_CELL), F.col("line"))
    groups = lines.groupBy("uri", text.alias("text")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("at").alias("at"),
        F.min(F.when(F.btrim("line", F.lit(" \t\n\x0b\f\r")) != "", F.col("at"))).alias("filled_at"),
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"),
    )
    head = preamble_lines + 1
    placed = F.when(F.col("text").isNotNull(), F.struct("at", "text"))
    candidates = [F.min(F.when(F.pmod("at", F.lit(head)) == r, placed)).alias(f"line_{r}") for r in range(head)]
    files = groups.groupBy("uri").agg(
        F.sum("n").alias("line_count"),
        F.min("at").alias("begin"),
        F.min("filled_at").alias("filled_at"),
        F.bool_and("utf8").alias("utf8"),
        F.min(F.when(F.col("text").isNotNull(), F.struct("filled_at", "text"))).alias("first"),
        *candidates,
    )
    found = F.array_sort(F.array_compact(F.array(*(F.col(f"line_{r}") for r in range(head)))))
    at = lambda k: F.try_element_at(
        F.filter(found, lambda x: x["at"] == F.col("begin") + k), F.lit(1)
    )["text"]
    before = F.filter(found, lambda x: x["at"] < F.col("begin") + preamble_lines)
    return files.select(
        "uri",
        plain_path(F.col("uri")).alias("path"),
        "line_count",
        "utf8",
        decoded(at(0), F.col("utf8")).alias("opening"),
        F.when(F.col("first.filled_at") == F.col("filled_at"), F.col("first.text")).alias("first_text"),
        decoded(at(preamble_lines), F.col("utf8")).alias("header_line"),
        F.transform(before, lambda x: decoded(x["text"], F.col("utf8"))).alias("preamble"),
    )


def decoded(line: Column, utf8: Column) -> Column:
    """The line as text: its bytes are UTF-8, or Latin-1 where the file as a whole is not."""
    return F.when(utf8, line).otherwise(F.decode(line.cast("binary"), "ISO-8859-1"))


_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def cells(line: Column, limit: Column | int = -1) -> Column:
    """Cells of a line; with ``limit``, the last one holds the rest of the line.

    Looking for commas outside quotes takes time quadratic in the line, so only quoted lines pay.
    """
    plain = lambda c: F.replace(F.regexp_replace(c, '^\\s*"(.*)"\\s*$', "$1"), F.lit('""'), F.lit('"'))
    quoted = F.transform(F.split(line, _COMMA, limit), plain)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", limit))
