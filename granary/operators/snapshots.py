"""Selecting partitions of snapshot tables and finding holes in them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import dates


def latest_partition(
    df: DataFrame, column: str = "partition_date", as_of: dt.date | str | None = None
) -> DataFrame:
    """Rows of the newest partition, or of the newest one not after ``as_of``.

    The newest date is a scalar subquery, which Spark runs first and uses to prune
    partition directories.
    """
    known = df.select(column)
    if as_of is not None:
        known = known.filter(F.col(column) <= dates.day_lit(as_of))
    newest = known.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)


def latest_if_partitioned(df: DataFrame, column: str = "partition_date") -> DataFrame:
    """``latest_partition`` for a stored table; a frame without the column passes through."""
    return latest_partition(df, column) if column in df.columns else df


def newest_date(
    df: DataFrame, as_of: dt.date | str, column: str = "partition_date", lookback_days: int = 8
) -> dt.date | None:
    """Newest date of a stored table not after ``as_of``.

    The search looks at the last days first and widens only while nothing is found, so
    partition pruning keeps it from opening the files of the whole history.
    """
    last = dates.to_day(as_of)
    until = df.select(column).filter(F.col(column) <= dates.day_lit(last))
    for days in (lookback_days, 8 * lookback_days, 64 * lookback_days, None):
        known = until if days is None else until.filter(F.col(column) > dates.day_lit(last - dt.timedelta(days=days)))
        found = known.agg(F.max(column)).first()[0]
        if found is not None:
            return found
    return None


def stored_partition(df: DataFrame, as_of: dt.date | str, column: str = "partition_date") -> DataFrame:
    """``latest_partition`` of a stored table, with the date as a literal in the plan."""
    found = newest_date(df, as_of, column)
    return df.filter(F.lit(False)) if found is None else df.filter(F.col(column) == dates.day_lit(found))


def each_day(
    df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "partition_date"
) -> DataFrame:
    """For every day in [start, end], the rows ``stored_partition`` has, keyed by ``as_of``."""
    start, end = dates.to_day(start), dates.to_day(end)
    first = newest_date(df, start, column) or start
    recent = df.filter(F.col(column).between(dates.day_lit(first), dates.day_lit(end)))
    # One row per day of the range.
    served = snapshot_calendar(recent, start + dt.timedelta(days=1), end + dt.timedelta(days=1), column).select(
        F.date_sub("as_of", 1).alias("as_of"), F.col("snapshot_date").alias(column)
    )
    return recent.join(F.broadcast(served), column)


def snapshot_before(df: DataFrame, as_of: dt.date | str, column: str = "partition_date") -> DataFrame:
    """Newest partition no later than the day before ``as_of``."""
    return latest_partition(df, column, dates.to_day(as_of) - dt.timedelta(days=1))


def snapshot_calendar(
    df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "partition_date"
) -> DataFrame:
    """For each day in [start, end], the partition ``snapshot_before`` would pick.

    Each partition serves the days after it up to and including the next partition's
    own date, so the mapping is an expansion of the (few) partition dates, not a join.
    """
    start, end = dates.to_day(start), dates.to_day(end)
    # One row per partition date of the table: a calendar-sized window.
    ordered = Window.orderBy(column)
    served = (
        df.filter(F.col(column) < dates.day_lit(end))
        .select(column)
        .distinct()
        .select(
            column,
            F.greatest(F.date_add(column, 1), dates.day_lit(start)).alias("first_day"),
            # ``least`` skips the null successor of the newest partition.
            F.least(F.lead(column).over(ordered), dates.day_lit(end)).alias("last_day"),
        )
        .filter(F.col("first_day") <= F.col("last_day"))
    )
    return served.select(
        F.explode(F.sequence("first_day", "last_day")).alias("as_of"),
        F.col(column).alias("snapshot_date"),
    )


def trailing(df: DataFrame, column: str | Column, as_of: dt.date | str, days: int) -> DataFrame:
    """Rows dated ``as_of - days`` or later (no upper bound)."""
    c = F.col(column) if isinstance(column, str) else column
    return df.filter(c >= dates.day_lit(dates.to_day(as_of) - dt.timedelta(days=days)))


def _gap_window(yesterday: dt.date | str, lookback_days: int) -> tuple[Column, Column]:
    last = dates.to_day(yesterday)
    first = last - dt.timedelta(days=lookback_days - 1)
    return dates.day_lit(first), dates.day_lit(last)


def missing_dates(
    df: DataFrame, column: str, yesterday: dt.date | str, lookback_days: int = 7
) -> DataFrame:
    """Days in [yesterday - (n-1), yesterday] for which the table has no row."""
    first, last = _gap_window(yesterday, lookback_days)
    expected = df.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.sequence(first, last)).alias("missing_date")
    )
    present = (
        df.select(F.col(column).alias("missing_date"))
        .filter(F.col("missing_date").between(first, last))
        .distinct()
    )
    return expected.join(present, "missing_date", "left_anti")


def missing_dates_by(
    df: DataFrame, key: str, column: str, yesterday: dt.date | str, lookback_days: int = 7
) -> DataFrame:
    """``missing_dates`` for every value of ``key``, for tables fed by several sources."""
    first, last = _gap_window(yesterday, lookback_days)
    in_window = F.when(F.col(column).between(first, last), F.col(column))
    seen = df.select(key, in_window.alias("missing_date")).distinct()
    expected = (
        seen.select(key).distinct().select(key, F.explode(F.sequence(first, last)).alias("missing_date"))
    )
    return expected.join(seen, [key, "missing_date"], "left_anti")
