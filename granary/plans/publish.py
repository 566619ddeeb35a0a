"""Publishing frames as tables: schema check, staging, idempotent partition replacement."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import dates
from granary.schemas import Entity, Field
from granary.sources import commits, sinks

Values = dict[str, str]


def conform(df: DataFrame, entity: Entity, with_partition: bool = False) -> DataFrame:
    """Columns of ``entity`` in order and in their declared types; a missing one fails."""
    fields: tuple[Field, ...] = entity.fields + (entity.partition if with_partition else ())
    return df.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in fields])


def partition_path(root: str, column: str, day: dt.date | str) -> str:
    return f"{root.rstrip('/')}/{column}={dates.to_day(day).isoformat()}"


def _values(partition: str) -> Values:
    """``a=1/b=2`` -> column values as text."""
    return dict(part.split("=", 1) for part in partition.split("/"))


def replace_partitions(
    df: DataFrame,
    columns: list[str],
    root: str,
    staging: str | None = None,
    file_format: str = "parquet",
    emptied: list[str] = (),
    read: dict[str, dict[str, int]] | None = None,
) -> list[Values]:
    """Replace every partition present in ``df``, and by nothing those in ``emptied``.

    One partitioned write into a folder of this run, then one switch of all its partitions:
    a failed computation or copy leaves the table as it was, runs at the same time keep
    apart, and ``df`` may read the table. With ``read`` (see ``commits.commit``) nothing is
    replaced if folders have changed since. Returns the partitions that were replaced.
    """
    spark, run = df.sparkSession, commits.new_run()
    folder = f"{(staging or commits.staging_of(root)).rstrip('/')}/run={run}"
    files = commits.Files(spark, root)
    try:
        sinks.WRITERS[file_format](df, folder, columns)
        touched = commits.partitions(files, folder, columns)
        for partition in emptied:
            if partition not in touched:
                sinks.write_parquet(df.drop(*columns).limit(0), f"{folder}/{partition}")
                touched.append(partition)
        commits.commit(spark, root, run, {f"{root.rstrip('/')}/{p}": f"{folder}/{p}" for p in touched}, read)
    finally:
        commits.clear(spark, root, run, folder)
    return [_values(p) for p in touched]


def publish_partition(
    df: DataFrame, entity: Entity, root: str, staging_root: str, day: dt.date | str
) -> str:
    """Replace exactly one day of a table; running it twice equals running it once.

    An empty report empties the day; otherwise see ``replace_partitions``.
    """
    (column,) = entity.partition_columns
    rows = conform(df, entity).withColumn(column, dates.day_lit(day))
    final = partition_path(root, column, day)
    replace_partitions(rows, [column], root, f"{staging_root.rstrip('/')}/{entity.name}", emptied=[final.rsplit("/", 1)[1]])
    return final


def clear_day(like: DataFrame, entity: Entity, root: str, day: dt.date | str) -> str:
    """Empty one day of a table; ``like`` has its columns."""
    final = partition_path(root, entity.partition_columns[0], day)
    sinks.write_parquet(like.select(*entity.columns).limit(0), final)
    return final


def publish_range(df: DataFrame, entity: Entity, root: str) -> None:
    """Replace every day present in ``df`` in one job; other days stay as they are."""
    replace_partitions(conform(df, entity, with_partition=True), entity.partition_columns, root)


def stored_days(spark: SparkSession, entity: Entity, root: str) -> list[dt.date]:
    """Days that a table by day has folders for, from the listing of its folder."""
    names = commits.partitions(commits.Files(spark, root), root.rstrip("/"), entity.partition_columns)
    return sorted(dates.to_day(n.split("=", 1)[1]) for n in names if not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def replace_range(
    df: DataFrame, entity: Entity, root: str, staging_root: str, start: dt.date | str, end: dt.date | str
) -> None:
    """Replace all days in [start, end]: days of ``df`` by its rows, all others by nothing."""
    (column,) = entity.partition_columns
    first, last = dates.to_day(start), dates.to_day(end)
    rows = conform(df, entity, with_partition=True).filter(F.col(column).between(dates.day_lit(first), dates.day_lit(last)))
    held = [f"{column}={d}" for d in stored_days(df.sparkSession, entity, root) if first <= d <= last]
    replace_partitions(rows, [column], root, f"{staging_root.rstrip('/')}/{entity.name}", emptied=held)


def publish_full(df: DataFrame, entity: Entity, root: str) -> None:
    """Replace the whole table; ``df`` may read it. A failure leaves the old one."""
    replace_folders({root: conform(df, entity)}, root)


def replace_folders(frames: dict[str, DataFrame], root: str) -> None:
    """Replace folders at or below ``root`` by frames. All are complete before any is replaced,
    so a frame that fails leaves all of them as they were."""
    run = commits.new_run()
    folder = f"{commits.staging_of(root)}/run={run}"
    staged = {target.rstrip("/"): f"{folder}/{i}" for i, target in enumerate(frames)}
    spark = next(iter(frames.values())).sparkSession
    try:
        for place, frame in zip(staged.values(), frames.values(), strict=True):
            sinks.write_parquet(frame, place)
        commits.commit(spark, root, run, staged)
    finally:
        commits.clear(spark, root, run, folder)


def _quoted(text: str) -> str:
    if "'" in text or '"' in text:
        raise ValueError(f"description must not contain quotes: {text}")
    return f"'{text}'"


def _column_sql(field: Field) -> str:
    comment = f" COMMENT {_quoted(field.comment)}" if field.comment else ""
    return f"`{field.name}` {field.type}{comment}"


def create_table_sql(
    entity: Entity, table: str, location: str | None = None, file_format: str = "parquet"
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` statement of a declared table."""
    columns = ",\n  ".join(_column_sql(f) for f in entity.fields + entity.partition)
    parts = [f"CREATE TABLE IF NOT EXISTS {table} (\n  {columns}\n)", f"USING {file_format}"]
    if entity.partition:
        parts.append(f"PARTITIONED BY ({', '.join(entity.partition_columns)})")
    if location:
        parts.append(f"LOCATION '{location}'")
    if entity.comment:
        parts.append(f"COMMENT {_quoted(entity.comment)}")
    return "\n".join(parts)


def create_table(spark: SparkSession, entity: Entity, table: str, location: str | None = None) -> None:
    spark.sql(create_table_sql(entity, table, location))


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make partition directories written by path visible to the catalog table."""
    spark.catalog.recoverPartitions(table)


def register_values(spark: SparkSession, entity: Entity, table: str, values: list[Values]) -> None:
    """Register the partitions a write has touched, without listing the table."""
    literal = {f.name: "DATE " if f.type == "date" else "" for f in entity.partition}
    parts = ["PARTITION (" + ", ".join(f"{c} = {kind}{_quoted(v[c])}" for c, kind in literal.items()) + ")" for v in values]
    for begin in range(0, len(parts), 500):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts[begin : begin + 500])}")
    spark.catalog.refreshTable(table)


def register_days(
    spark: SparkSession, entity: Entity, table: str, start: dt.date | str, end: dt.date | str | None = None
) -> None:
    """Register the days a job has replaced, without listing the table."""
    (column,) = entity.partition_columns
    first, last = dates.to_day(start), dates.to_day(end or start)
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    register_values(spark, entity, table, [{column: d.isoformat()} for d in days])


def publish_to_table(df: DataFrame, entity: Entity, table: str, day: dt.date | str) -> None:
    """Replace one partition of a catalog table, the others untouched."""
    (column,) = entity.partition_columns
    # A static partition clause clears that partition even when the report is empty.
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = DATE '{dates.to_day(day)}') "
        "SELECT * FROM {report}",
        report=conform(df, entity),
    )


def report_query(spark: SparkSession, sql: str, **params: Any) -> DataFrame:
    """Parameterised report text; ``:name`` markers are bound as values, not pasted."""
    return spark.sql(sql, args=params)
