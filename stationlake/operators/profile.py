"""Inspection of raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.cells import to_number


def column_presence(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column with status OK or MISSING."""
    rows = [(name, "OK" if name in df.columns else "MISSING") for name in expected]
    return df.sparkSession.createDataFrame(rows, "column_name string, status string")


def key_profile(
    df: DataFrame, keys: Sequence[str], flagged: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Per group: total_rows, distinct_keys, duplicated_keys and flagged_rows.

    Rows are first counted per key, so the second step sees one row per distinct key.
    """
    per_key = df.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(flagged).alias("n_flagged")
    )
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.sum("n_flagged").alias("flagged_rows"),
    )


def _cells(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    text = df.select(*by, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot(list(by), [F.col(f"`{c}`") for c in columns], "column_name", "cell")


def numeric_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per column (and group): rows, readings, missing and negative ones, and the range.

    All columns are profiled in one scan; columns that ``df`` does not have are left out.
    """
    present = [c for c in columns if c in df.columns]
    value = F.col("value")
    total = F.count(F.lit(1))
    return (
        _cells(df, present, by)
        .withColumn("value", to_number(F.col("cell")))
        .groupBy(*by, "column_name")
        .agg(
            total.alias("total_rows"),
            F.count(value).alias("valid_readings"),
            (total - F.count(value)).alias("missing_readings"),
            F.count_if(value < 0).alias("negative_readings"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
    )


def inferred_types(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per text column: how many of its cells read as BIGINT, DOUBLE or DATE, and the narrowest
    type that takes all of them."""
    cell = F.col("cell")
    filled = F.count(cell)
    as_bigint = F.count_if(cell.rlike(r"^\s*[+-]?\d+\s*$") & cell.try_cast("bigint").isNotNull())
    as_double = F.count(to_number(cell))
    as_date = F.count_if(
        cell.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$") & F.trim(cell).try_cast("date").isNotNull()
    )
    counted = (
        _cells(df, columns, by)
        .groupBy(*by, "column_name")
        .agg(
            filled.alias("filled_cells"),
            as_bigint.alias("bigint_cells"),
            as_double.alias("double_cells"),
            as_date.alias("date_cells"),
        )
    )
    fits = lambda name: (F.col("filled_cells") > 0) & (F.col(name) == F.col("filled_cells"))
    return counted.withColumn(
        "suggested_type",
        F.when(fits("bigint_cells"), "BIGINT")
        .when(fits("double_cells"), "DOUBLE")
        .when(fits("date_cells"), "DATE")
        .otherwise("VARCHAR"),
    )
