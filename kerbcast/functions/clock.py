"""Dates, months and durations on local wall-clock timestamps.

All helpers work on TIMESTAMP_NTZ without passing through the session time zone, so a
daylight-saving change in the session's zone cannot move a pickup to another hour.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbcast.functions.exact import MICROS_PER_MINUTE


def to_month(value: str | dt.date) -> dt.date:
    """First day of a month given as a date or as text (``2026-8`` or ``2026-08``)."""
    if isinstance(value, str):
        year, month = value.split("-")[:2]
        return dt.date(int(year), int(month), 1)
    return dt.date(value.year, value.month, 1)


def shift_month(month: dt.date, by: int) -> dt.date:
    index = month.year * 12 + month.month - 1 + by
    return dt.date(index // 12, index % 12 + 1, 1)


def month_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def parse_month(text: Column | str) -> Column:
    """First day of the month named by ``yyyy-M`` or ``yyyy-MM`` text."""
    return F.to_date(text, "yyyy-M")


def month_of(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(ts.cast("date"), "month")


def month_sequence(first: Column, last: Column) -> Column:
    """Every month start from ``first`` to ``last``, inclusive."""
    return F.sequence(first, last, F.expr("interval 1 month"))


def months_ending_at(last: Column, count: Column) -> Column:
    """The ``count`` calendar months that end at ``last``."""
    return month_sequence(F.add_months(last, F.lit(1) - count), last)


def wall_micros(ts: Column) -> Column:
    """Microseconds on the wall clock since 1970-01-01 00:00."""
    seconds_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60
    micros_of_minute = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
        + seconds_of_day.cast("bigint") * 1_000_000
        + micros_of_minute
    )


def minutes_between(start: Column, end: Column) -> Column:
    return (wall_micros(end) - wall_micros(start)) / F.lit(MICROS_PER_MINUTE)


def day_of_week(day: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(day).cast("int")


def local_today(as_of: Column, zone: str) -> Column:
    """The calendar date of an instant (given as a UTC wall-clock reading) in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_of.cast("timestamp_ntz")).cast("date")
