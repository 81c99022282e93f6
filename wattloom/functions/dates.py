"""Date and time functions on columns.

Meter time is local wall-clock time, held as TIMESTAMP_NTZ. Pattern parsing goes through the session
zone, so sessions run on UTC (see ``session.build_session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattloom.functions.values import as_column, flag_when, map_values
from wattloom.lookups import SEASONS


def parse_ts(c: str | Column, fmt: str = "M/d/yy H:mm") -> Column:
    """Text to timestamp by pattern; unreadable text becomes NULL."""
    return F.try_to_timestamp(as_column(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_ts_coerce(c: str | Column) -> Column:
    """ISO text to timestamp; unreadable text becomes NULL."""
    return as_column(c).try_cast("timestamp_ntz")


def parse_mixed_date(c: str | Column) -> Column:
    """Text to date: ISO stays year-month-day, slashed text is day first, the rest is NULL."""
    text = F.trim(as_column(c))
    return F.coalesce(text.try_cast("date"), F.try_to_date(text, "d/M/yyyy"))


def format_date(c: str | Column, fmt: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_column(c), fmt)


def to_day(c: str | Column) -> Column:
    return F.to_date(as_column(c))


def day_name(c: str | Column) -> Column:
    return F.date_format(as_column(c), "EEEE")


def month_name(c: str | Column) -> Column:
    return F.date_format(as_column(c), "MMMM")


def day_of_week(c: str | Column, base: str = "sunday1") -> Column:
    """Weekday number: ``sunday1`` gives Sunday 1 .. Saturday 7, ``monday0`` Monday 0 .. Sunday 6."""
    if base == "sunday1":
        return F.dayofweek(as_column(c))
    if base == "monday0":
        return F.weekday(as_column(c))
    raise ValueError(f"unknown weekday numbering: {base}")


def is_weekend(c: str | Column) -> Column:
    return flag_when(F.weekday(as_column(c)) >= 5)


def month_of(c: str | Column) -> Column:
    return F.month(as_column(c))


def hour_of(c: str | Column) -> Column:
    return F.hour(as_column(c))


def time_of_day(c: str | Column) -> Column:
    return F.date_format(as_column(c), "HH:mm")


def month_period(c: str | Column) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def season(c: str | Column) -> Column:
    """Season of a date, from its month."""
    return map_values(month_name(c), SEASONS)


def epoch_to_date(c: str | Column) -> Column:
    """Epoch seconds to the UTC date, whatever the session zone."""
    days = F.floor(as_column(c) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, in hours; NULL when either is NULL."""
    return F.timestamp_diff("SECOND", as_column(start), as_column(end)) / F.lit(3600.0)


def epoch_hours_between(start: str | Column, end: str | Column) -> Column:
    """Hours between two epoch seconds; a zero counts as missing."""
    zero = F.lit(0).cast("bigint")
    return (F.nullif(as_column(end), zero) - F.nullif(as_column(start), zero)) / F.lit(3600.0)
