"""Table scans.

Tables are read by their declared schemas and exports by their header, every column as text:
no type is inferred from data. A line that does not fit stops the job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import dates, text
from granary.schemas import FORMULAS, Entity
from granary.sources import exports


def read_formulas_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Recipe export: headers are ignored and columns are named by position."""
    return exports.read(spark, path, by_name=False).toDF(*FORMULAS.columns)


def read_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Stock or manufacturing-order export: headers are tidied to column names."""
    return text.tidy_names(exports.read(spark, path, by_name=True))


def _file_schema(entity: Entity) -> T.StructType:
    return entity.struct(with_partition=True)


def read_csv_table(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    """Headered, comma-delimited, date-partitioned text table; its header must be the
    declared one. Values hold no delimiters (``sanitize_delimiters``), so files split."""
    options = exports.OPTIONS | {"multiLine": False, "enforceSchema": False}
    return spark.read.schema(_file_schema(entity)).options(**options).csv(root)


def read_json_table(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    return spark.read.schema(_file_schema(entity)).option("mode", "FAILFAST").json(root)


def read_parquet_table(spark: SparkSession, root: str, entity: Entity | None = None) -> DataFrame:
    reader = spark.read if entity is None else spark.read.schema(_file_schema(entity))
    return reader.parquet(root)


def with_day_from_parts(df: DataFrame, name: str = "order_date") -> DataFrame:
    """Date column from the year/month/day directory columns."""
    return df.withColumn(name, dates.compose_day(F.col("year"), F.col("month"), F.col("day")))


def date_slice(df: DataFrame, column: str | Column, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows whose date lies in [start, end]."""
    c = F.col(column) if isinstance(column, str) else column
    return df.filter(c.between(dates.day_lit(start), dates.day_lit(end)))


def rows_per_date(df: DataFrame, date_column: str) -> DataFrame:
    return df.groupBy(date_column).agg(F.count("*").alias("row_count"))


def has_rows_on(df: DataFrame, date_column: str, day: dt.date | str) -> bool:
    """Probe for source data on one day; reads until the first hit only."""
    return not df.filter(F.col(date_column) == dates.day_lit(day)).isEmpty()
