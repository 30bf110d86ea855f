"""Dates and timestamps out of text, including the 24:00 convention.

Everything here is zone-less (``timestamp_ntz``), so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_FIRST = r"^\d{1,2}([/-])\d{1,2}\1\d{4}$"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ISO_WITH_TIME = r"^\d{4}-\d{1,2}-\d{1,2} (?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"
_CLOCK = r"^(?:(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d{1,6})?)?|24:0?0(?::0?0(?:\.0+)?)?)$"


def parse_date(cell: Column, day_first_only: bool = False) -> Column:
    """DATE from ``yyyy-M-d``, ``d/M/yyyy``, ``d-M-yyyy`` or ``yyyy-M-d H:m:s``; otherwise NULL.

    Every accepted shape is rewritten to ISO and cast. That keeps failing cells cheap: Spark's date
    cast returns NULL without raising inside, unlike a chain of pattern-based parsers.
    """
    text = F.trim(cell)
    dashed = F.translate(text, "/", "-")
    month = F.substring_index(F.substring_index(dashed, "-", 2), "-", -1)
    turned = F.concat_ws(
        "-", F.substring_index(dashed, "-", -1), month, F.substring_index(dashed, "-", 1)
    )
    day_first = text.rlike(_DAY_FIRST)
    if day_first_only:
        return F.when(day_first, turned.try_cast("date"))
    return (
        F.when(text.rlike(_ISO), text.try_cast("date"))
        .when(day_first, turned.try_cast("date"))
        .when(text.rlike(_ISO_WITH_TIME), F.substring_index(text, " ", 1).try_cast("date"))
    )


def clock_is_valid(cell: Column) -> Column:
    """True for 00:00 .. 23:59:59 and for 24:00 with zero minutes; NULL for NULL."""
    return F.trim(cell).rlike(_CLOCK)


def at_clock(day: Column, cell: Column, strict: bool = True) -> Column:
    """``day`` plus the time of day in ``cell``; 24:00 is midnight of the next day.

    A NULL day or time gives NULL. A time that does not exist (25:00, 24:30) raises when ``strict``
    and gives NULL otherwise.
    """
    text = F.trim(cell)
    part = lambda n: F.split_part(text, F.lit(":"), F.lit(n))
    seconds = F.coalesce(F.nullif(part(3), F.lit("")), F.lit("0"))
    # The casts sit behind the shape check, but Spark may evaluate them earlier: use try_cast.
    moment = day.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0),
        part(1).try_cast("int"),
        part(2).try_cast("int"),
        seconds.try_cast("decimal(18,6)"),
    )
    ok = clock_is_valid(cell)
    if not strict:
        return F.when(ok, moment)
    complaint = F.raise_error(F.concat(F.lit("not a time of day: "), text))
    return F.when(ok | day.isNull(), moment).when(~ok, complaint.cast("timestamp_ntz"))


def hour_floor(moment: Column) -> Column:
    """Start of the hour. ``date_trunc`` would go through the session time zone."""
    zero = F.lit(0)
    return moment.cast("date").cast("timestamp_ntz") + F.make_dt_interval(zero, F.hour(moment), zero, zero)
