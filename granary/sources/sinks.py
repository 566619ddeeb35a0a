"""Partitioned writers.

Each writer is one job over the whole frame. ``rebalance`` groups rows of a partition
value into few files and lets adaptive execution split a value that is too large, so a
hot day neither lands in one task nor leaves thousands of tiny files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import dates, text

_REPLACE_TOUCHED = {"partitionOverwriteMode": "dynamic"}


def _rebalanced(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.hint("rebalance", *columns)


def write_csv_by(df: DataFrame, root: str, columns: list[str]) -> None:
    """Headered text files per partition value; only partitions present in ``df`` change."""
    safe = text.sanitize_delimiters(df)
    (
        _rebalanced(safe, columns)
        .write.mode("overwrite")
        .options(**_REPLACE_TOUCHED)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .partitionBy(*columns)
        .csv(root)
    )


def split_by_day(df: DataFrame, source: str, column: str, start=None, end=None) -> DataFrame:
    """Add the day of ``source`` as partition column and keep days in [start, end]."""
    out = df.withColumn(column, F.to_date(F.col(source)))
    if start is not None:
        out = out.filter(F.col(column) >= dates.day_lit(start))
    if end is not None:
        out = out.filter(F.col(column) <= dates.day_lit(end))
    return out


def write_orders_by_day(df: DataFrame, root: str, start=None, end=None) -> None:
    """All days of a multi-day frame in one partitioned write."""
    write_csv_by(split_by_day(df, "purchase_date", "order_date", start, end), root, ["order_date"])


def with_day_parts(df: DataFrame, day: str | Column) -> DataFrame:
    c = F.col(day) if isinstance(day, str) else day
    return df.withColumns(dates.day_parts(c))


def write_csv_by_ymd(df: DataFrame, root: str, day: str | Column) -> None:
    """Layout ``year=YYYY/month=MM/day=DD``."""
    write_csv_by(with_day_parts(df, day), root, ["year", "month", "day"])


def write_json_lines(df: DataFrame, root: str, load_day, column: str = "load_dt") -> None:
    """JSON lines under ``load_dt=...``; re-running a load day replaces it."""
    (
        df.withColumn(column, dates.day_lit(load_day))
        .write.mode("overwrite")
        .options(**_REPLACE_TOUCHED)
        .partitionBy(column)
        .json(root)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    """Gzip Parquet, replacing the directory."""
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_parquet_by(df: DataFrame, root: str, columns: list[str]) -> None:
    """Gzip Parquet per partition value; only partitions present in ``df`` change."""
    (
        _rebalanced(df, columns)
        .write.mode("overwrite")
        .options(**_REPLACE_TOUCHED)
        .option("compression", "gzip")
        .partitionBy(*columns)
        .parquet(root)
    )


#: Partitioned writers by file format.
WRITERS = {"parquet": write_parquet_by, "csv": write_csv_by}
