"""Small helpers shared by the operators: typed inputs, scratch tables, Arrow batches, groups of rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from stationlake.session import scratch_dir

#: Text that one Python step holds at once. Arrow batches above it are worked off in slices.
SLICE_BYTES = 2 << 20


#: Bits that mark keys by their hash.
MARKS = 1 << 25


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that other columns cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and readable after an executor is lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Where the ties of null ids begin, so that no id that is a number can be taken for null.
NULL_TIE = 1 << 60
LAST = 2**63 - 1


def with_ties(df: DataFrame) -> DataFrame:
    """``df`` (doc_id, text and others) with the order of its rows: ``ord``, then ``tie``.

    ``ord`` is the id, a null one after all others. ``tie`` tells rows of the same id apart by the
    SHA-256 of their text (null as empty), and equal rows by a number; only where ids repeat are rows
    moved for it, dealt by id and the first digits of the digest.
    """
    body = df.withColumn("ord", F.coalesce("doc_id", F.lit(LAST)))
    null = F.when(F.col("doc_id").isNull(), F.lit(NULL_TIE)).otherwise(F.lit(0)).cast("long")
    if body.groupBy("ord").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return body.withColumn("tie", null)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    body = body.withColumn("tie_digest", digest)
    part = F.conv(F.substring("tie_digest", 1, 4), 16, 10).cast("long")
    number = F.row_number().over(Window.partitionBy("ord", part).orderBy("tie_digest"))
    return body.withColumn("tie", null + F.shiftleft(part, 40) + number).drop("tie_digest")


def id_of(ord_: str | Column, tie: str | Column) -> Column:
    """The doc_id of a place: null for the ties of null ids."""
    ord_, tie = (F.col(c) if isinstance(c, str) else c for c in (ord_, tie))
    return F.when((ord_ != LAST) | (tie < NULL_TIE), ord_)


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """ord, doc_id, text (null as empty) and tie; see ``with_ties``."""
    body = with_ties(texts(df, id_col, text_col))
    return body.select("ord", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "tie")


def annotated(
    df: DataFrame, text_col: str, fields: str, compute: Callable[[pa.Array], list[pa.Array]], limit: int | None = None
) -> DataFrame:
    """``df`` with the columns that ``compute`` makes of its texts, row by row and without a shuffle.

    ``fields`` names and types the new columns; a column of ``df`` with such a name is replaced.
    ``limit`` is the text worked on at once, in bytes.
    """
    added = T.StructType.fromDDL(fields)
    names = [n for n in df.columns if n != text_col and n not in added.names] + [text_col]
    plain = df.select(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)))
    schema = T.StructType([*plain.schema.fields, *added.fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit or SLICE_BYTES):
            made = compute(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    found = plain.mapInArrow(work, schema)
    return found.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(names)), *added.names)


def with_marks(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` with ``marked``: false only for rows whose ``key`` is in no row of ``wanted``.

    The keys are marked by their hash in a bit map of a fixed size, which every task gets; so texts that
    have no partner stay where they are. Of the marked rows a join decides.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MARKS))
    word, bit = F.floor(place / 64).alias("_word"), (place % 64).cast("int")
    marks = wanted.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
    marks = marks.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))  # at most MARKS / 64 rows
    rows = df.withColumn("_word", word).join(F.broadcast(marks), "_word", "left")
    return rows.select(*df.columns, F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False)).alias("marked"))


def bucket(n: int, *columns: str | Column) -> Column:
    """A number from 0 to n - 1 that depends on the values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(n))


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of a number written as text, modulo ``n``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(n))


#: Of the C library, where it has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """What earlier tasks freed goes back to the system. Spark keeps a Python worker for many tasks and
    stages; without this it stays as large as the largest of them made it. Called when a task begins and, for
    workers that then wait while others work, when its rows are at an end."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their last column (the text) exceeds ``limit`` bytes; one long text stays whole."""
    give_back()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def text_bytes(column: pa.Array) -> list[bytes]:
    """Every text as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str], least: int) -> Iterator[pa.Table]:
    """Whole groups from rows that arrive with equal keys together, at least ``least`` rows at a time."""
    give_back()
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        kept.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        edge = last_group(table, keys)
        if edge:
            yield table.slice(0, edge)
            table = table.slice(edge)
        kept, rows = table.to_batches(), table.num_rows
        # A group longer than the aim is not looked at again before it has doubled.
        least = max(least, 2 * rows) if not edge else least
    if rows:
        yield pa.Table.from_batches(kept).combine_chunks()
    kept.clear()
    give_back()


def starts_of_groups(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of values begins, in rows that have equal values together."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def last_group(table: pa.Table, keys: list[str]) -> int:
    columns = [table.column(k).to_numpy() for k in keys]
    return int(starts_of_groups(columns)[-1])


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``counts`` numbers each, one after the other."""
    counts = np.asarray(counts, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(np.asarray(starts) - (ends - counts), counts)
