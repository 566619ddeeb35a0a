"""Wall-clock and calendar helpers. ``as_of`` is always a parameter, never "now"."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(value: dt.date | str) -> dt.date:
    """Driver-side argument parsing."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day_lit(value: dt.date | str) -> Column:
    return F.lit(to_day(value))


def wall_clock(c: Column) -> Column:
    """ISO text -> timestamp without zone; an offset is dropped, not applied."""
    return c.try_cast("timestamp_ntz")


def wall_clock_text(c: Column, separator: str = " ") -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of a wall-clock timestamp, whatever the session zone."""
    seconds = F.substring(wall_clock(c).cast("string"), 1, 19)
    return seconds if separator == " " else F.translate(seconds, " ", separator)


def parse_day(c: Column) -> Column:
    """``YYYY-MM-DD`` text -> date; blank or malformed -> null."""
    return F.try_to_date(F.when(c != "", c), "yyyy-M-d")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def days_between(earlier: Column, later: Column) -> Column:
    return F.date_diff(later, earlier)


def compose_day(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def day_parts(c: Column) -> dict[str, Column]:
    """Zero-padded text parts for a year/month/day directory layout."""
    return {
        "year": F.lpad(F.year(c).cast("string"), 4, "0"),
        "month": F.lpad(F.month(c).cast("string"), 2, "0"),
        "day": F.lpad(F.day(c).cast("string"), 2, "0"),
    }


def plus_days(base: Column, days: Column) -> Column:
    """Date plus a day count that is cut to whole days."""
    return F.date_add(base, days.cast("int"))


def report_day(now_utc: dt.datetime) -> dt.date:
    """Default day of a report run: the day 24 hours ago (UTC)."""
    return (now_utc - dt.timedelta(hours=24)).date()


def local_day(now_utc: dt.datetime, offset_hours: int = -4) -> dt.date:
    """Business-local "today" at a fixed offset from UTC."""
    return (now_utc + dt.timedelta(hours=offset_hours)).date()
