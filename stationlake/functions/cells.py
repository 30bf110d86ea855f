"""Cleaning of text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that mean "no reading".
NULL_TOKENS = ("", " ", "NA", "N/A")

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?\d+)?\s*$"
_NOT_A_NUMBER = r"(?i)^\s*[+-]?nan\s*$"
_INFINITE = r"(?i)^\s*[+-]?(?:inf|infinity)\s*$"


def blank_tokens_to_null(cell: Column) -> Column:
    """Missing-value tokens become NULL; every other cell is kept as it is."""
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def is_nonblank(cell: Column) -> Column:
    return cell.isNotNull() & (F.trim(cell) != "")


def to_number(cell: Column, nan_policy: str = "keep") -> Column:
    """Text to DOUBLE, NULL when it is not a number.

    Spark's own cast takes ``1d`` and ``1.5f`` and refuses ``1_000``, so the shape is checked first.
    NaN and infinities are readings under ``nan_policy="keep"`` and NULL under ``"null"``.
    """
    if nan_policy not in ("keep", "null"):
        raise ValueError(f"unknown nan_policy {nan_policy!r}")
    plain = F.when(
        cell.rlike(_NUMBER), F.replace(cell, F.lit("_"), F.lit("")).try_cast("double")
    )
    if nan_policy == "null":
        return plain
    return plain.when(cell.rlike(_INFINITE), cell.try_cast("double")).when(
        cell.rlike(_NOT_A_NUMBER), F.lit(float("nan"))
    )


def drop_negative(value: Column) -> Column:
    """Negative readings are instrument faults and become NULL. Zero is a reading."""
    return F.when(value < 0, F.lit(None)).otherwise(value)
