"""Cleaning of whole columns.

Each step is its own projection. A later expression that mentions an earlier result several times
then reads a column, where one nested expression would parse the cell again for each mention.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions.cells import blank_tokens_to_null, drop_negative, to_number
from stationlake.functions.clock import at_clock, clock_is_valid, parse_date


def clean_readings(
    df: DataFrame, cell: str = "cell", value: str = "value", nan_policy: str = "keep"
) -> DataFrame:
    """Replace the text column ``cell`` by the DOUBLE column ``value``.

    Missing-value tokens, text that is no number, and negative readings are NULL.
    """
    return (
        df.withColumn(cell, blank_tokens_to_null(F.col(cell)))
        .withColumn(value, to_number(F.col(cell), nan_policy))
        .drop(cell)
        .withColumn(value, drop_negative(F.col(value)))
    )


def stamp(
    df: DataFrame, date: str, clock: str, into: str = "recorded_at", strict: bool = True
) -> DataFrame:
    """Add the timestamp made of the text columns ``date`` and ``clock``; rows without one drop out.

    The day comes out of a generator that yields nothing for an unusable date: a filter on it would be
    moved below the projection and parse every date a second time. The time is filtered by its shape.
    """
    day, time = f"__day_of_{into}", F.col(clock)
    usable = time.isNotNull() if strict else clock_is_valid(time)
    return (
        df.where(usable)
        .select("*", F.explode(F.array_compact(F.array(parse_date(F.col(date))))).alias(day))
        .withColumn(into, at_clock(F.col(day), time, strict))
        .drop(day)
    )
