"""Left join of long readings with a reference table that is unique per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.errors import KeyViolation


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """``KeyViolation`` if a key occurs twice: one aggregate over the key columns."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (repeated or 0) > 1:
        raise KeyViolation(f"the right side holds {repeated} rows for one {tuple(keys)}")


def left_join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = False
) -> DataFrame:
    """All rows of ``left`` with the matching columns of ``right``, or NULLs.

    ``right`` must hold each key once (``KeyViolation`` otherwise; ``unique`` says that it does by
    construction), so the row count of ``left`` is kept. Keys are compared as they are; NULL matches
    nothing. Adaptive execution broadcasts ``right`` if its measured size is below Spark's threshold,
    and otherwise splits the rows of a frequent key among tasks.
    """
    right = right.dropna(subset=list(keys))
    if not unique:
        require_unique(right, keys)
    return left.join(right, list(keys), "left")


def match_coverage(joined: DataFrame, witness: str) -> DataFrame:
    """One row: total_rows, matched_rows, unmatched_rows, match_pct. ``witness`` is a column that
    only a match fills."""
    total = F.count(F.lit(1))
    matched = F.count(F.col(witness))
    return joined.agg(
        total.alias("total_rows"),
        matched.alias("matched_rows"),
        (total - matched).alias("unmatched_rows"),
        F.round(F.try_divide(matched * F.lit(100.0), total), 2).alias("match_pct"),
    )
