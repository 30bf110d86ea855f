"""Primary-key checks. Counts combine on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stationlake.errors import KeyViolation


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``row_count``."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def key_summary(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """total_rows, distinct_keys, duplicated_keys and null_key_rows; one row, or one per ``by``.

    ``by`` columns must be determined by the key.
    """
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    grouping = [*keys, *[c for c in by if c not in keys]]
    per_key = df.groupBy(*grouping).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def check_summary(found: Row, keys: Sequence[str]) -> int:
    """The row count in a ``key_summary`` row; raises ``KeyViolation`` when the key is broken."""
    if found["null_key_rows"] or found["duplicated_keys"]:
        raise KeyViolation(
            f"key {tuple(keys)}: {found['duplicated_keys']} duplicated, "
            f"{found['null_key_rows']} rows with NULL"
        )
    return found["total_rows"]


def enforce_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of ``df``; raises ``KeyViolation`` unless ``keys`` is NOT NULL and unique."""
    return check_summary(key_summary(df, keys).first(), keys)
