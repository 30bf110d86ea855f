"""Keyed serving tables: partitioned Parquet folders, kept current by an upsert of touched partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.keys import check_summary, key_summary
from stationlake.operators.layout import as_table, replace_partitions
from stationlake.session import path_exists, stored


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after insert-or-update by ``changes``.

    A changed key takes every column of the new row, NULLs included; other keys stay; nothing is
    deleted. The keys must be unique in ``changes`` (see ``enforce_key``).
    """
    return target.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)


def read_table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The table at ``path``, without rows as long as nothing was published."""
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*columns)


def publish(
    changes: DataFrame,
    path: str,
    columns: dict[str, str],
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence[str],
    lookups: Sequence[str] = (),
) -> int:
    """Upsert ``changes`` into the table at ``path``; the number of partitions touched.

    ``partition_by`` must be determined by ``keys``. The touched partitions are merged in the shared
    folder first and then replaced by Spark's dynamic partition overwrite. Repeating a publish leaves
    the same rows, so one that was stopped is simply run again; a table has one publisher at a time.
    """
    spark = changes.sparkSession
    changes = as_table(changes, columns)
    # One job for the key check and for the partitions touched; one row per partition comes back.
    parts = key_summary(changes, keys, by=partition_by).collect()
    for part in parts:
        check_summary(part, keys)
    if parts:
        merged = changes
        if path_exists(spark, path):  # else there is nothing to merge with
            touched = reduce(or_, [reduce(and_, [F.col(c) == part[c] for c in partition_by]) for part in parts])
            merged = stored(upsert(read_table(spark, path, columns).where(touched), changes, keys), "merged")
        within = [*order, *[k for k in keys if k not in order]]
        replace_partitions(merged, path, partition_by, within, lookups=lookups)
    return len(parts)
