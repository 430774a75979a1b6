"""Times without a zone: literals, windows, date keys and durations."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = date | datetime


def ntz(value: AsOf) -> Column:
    """A timestamp literal without time zone; a date means its midnight."""
    text = value.isoformat(" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def day_of(as_of: AsOf) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def days_before(as_of: AsOf, days: int) -> date:
    """Midnight-based cut-off: the calendar day ``days`` before ``as_of``."""
    return day_of(as_of) - timedelta(days=days)


def date_key(column: Column) -> Column:
    """yyyymmdd as an integer, from a date or timestamp."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def date_key_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end; negative when the end lies before the start."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def start_of_hour(column: Column) -> Column:
    """The full hour of a timestamp without zone; ``date_trunc`` would go through a zone."""
    return F.timestamp_add("HOUR", F.hour(column), column.cast("date").cast("timestamp_ntz"))


def sum_minutes(minutes: Column) -> Column:
    """Sum of durations through whole seconds, so that no order of adding changes the result.

    ``floor`` of half a second more rounds without the decimal detour that ``round`` takes.
    """
    return F.sum(F.floor(minutes * 60 + 0.5)) / F.lit(60.0)
