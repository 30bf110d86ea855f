"""Wide rows to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.errors import MissingColumnError


def unpivot_measures(
    wide: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    name_column: str = "pollutant",
    value_column: str = "value",
) -> DataFrame:
    """One row per (row, measure) with the measure's code; NULL readings stay as rows.

    A single Expand over a single scan. Columns that are computed per row belong in ``ids``, so they
    are computed once and not once per measure.
    """
    absent = [raw for raw in measures if raw not in wide.columns]
    if absent:
        raise MissingColumnError(f"no column {absent}")
    renamed = wide.select(
        *[F.col(f"`{c}`") for c in ids],
        *[F.col(f"`{raw}`").alias(code) for raw, code in measures.items()],
    )
    codes = [F.col(f"`{code}`") for code in measures.values()]
    return renamed.unpivot([F.col(f"`{c}`") for c in ids], codes, name_column, value_column)
