"""Index of the days that hold an order, for tables of order lines by day.

Entries ``(order, day)`` lie in buckets by a hash of the order, one folder for each batch that
wrote some. Of an order only the entries of its newest batch count; an entry without a day
says that the order has no lines. So a batch appends to the buckets of its own orders and a
look-up reads these buckets, never the table. ``compact`` keeps the newest entries only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.schemas import ORDER_DETAILS
from granary.sources import commits, scans, sinks

DAY, ORDER = "order_date", "shipbob_order_id"
BUCKETS = 64
_SCHEMA = f"{ORDER} bigint, {DAY} date, bucket int, batch bigint"


def path(root: str) -> str:
    """Folder of a table's index."""
    return f"{root.rstrip('/')}.days"


def _bucket() -> Column:
    return F.pmod(F.xxhash64(ORDER), F.lit(BUCKETS)).cast("int")


def exists(spark: SparkSession, root: str) -> bool:
    return bool(commits.Files(spark, root).names(path(root)))


def forget(spark: SparkSession, root: str) -> None:
    """Drop the index of a table that something else has written to; it is built anew."""
    commits.drop(spark, path(root))


def next_batch(spark: SparkSession, root: str) -> int:
    """A number above those of all batches in the index, from its folders."""
    files = commits.Files(spark, root)
    found = commits.partitions(files, path(root), ["bucket", "batch"])
    return 1 + max((int(p.rsplit("=", 1)[1]) for p in found), default=0)


def _entries(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path(root))


def add(spark: SparkSession, root: str, entries: DataFrame, batch: int) -> None:
    """Add ``entries(order, day)`` of a batch; adding them again changes nothing."""
    rows = entries.select(ORDER, DAY).distinct().withColumns({"bucket": _bucket(), "batch": F.lit(batch).cast("bigint")})
    sinks.write_parquet_by(rows, path(root), ["bucket", "batch"])


def build(spark: SparkSession, root: str) -> None:
    """The index of a table that has none, from its order column: once, not in every batch."""
    rows = scans.read_parquet_table(spark, root, ORDER_DETAILS).select(ORDER, DAY).distinct()
    entries = rows.withColumns({"bucket": _bucket(), "batch": F.lit(0).cast("bigint")})
    folder = f"{commits.staging_of(path(root))}/run={commits.new_run()}"
    sinks.write_parquet_by(entries, folder, ["bucket", "batch"])
    if not commits.Files(spark, root).names(folder):
        commits.drop(spark, folder)
        return
    commits.commit(spark, path(root), folder.rsplit("=", 1)[1], {path(root): folder})
    commits.drop(spark, folder)


def _newest(entries: DataFrame) -> DataFrame:
    """Entries of each order's newest batch."""
    newest = F.max("batch").over(Window.partitionBy(ORDER))
    return entries.withColumn("_newest", newest).filter("batch = _newest").drop("_newest")


def days_of(spark: SparkSession, root: str, orders: DataFrame) -> DataFrame:
    """``(order, day)`` for the days that hold lines of ``orders``."""
    asked = orders.select(ORDER).distinct()
    buckets = [r["bucket"] for r in asked.select(_bucket().alias("bucket")).distinct().collect()]
    entries = _entries(spark, root).filter(F.col("bucket").isin(buckets)).join(asked, ORDER, "left_semi")
    return _newest(entries).filter(F.col(DAY).isNotNull()).select(ORDER, DAY)


def compact(spark: SparkSession, root: str) -> None:
    """Leave the newest entries of each order only, all buckets in one switch."""
    run, base = commits.new_run(), path(root)
    folder = f"{commits.staging_of(base)}/run={run}"
    batch = next_batch(spark, root) - 1
    kept = _newest(_entries(spark, root)).filter(F.col(DAY).isNotNull()).withColumn("batch", F.lit(batch).cast("bigint"))
    try:
        sinks.write_parquet_by(kept, folder, ["bucket", "batch"])
        files = commits.Files(spark, root)
        for emptied in set(files.names(base)) - set(files.names(folder)):
            sinks.write_parquet(kept.limit(0).select(ORDER, DAY), f"{folder}/{emptied}/batch={batch}")
        commits.commit(spark, base, run, {f"{base}/{b}": f"{folder}/{b}" for b in files.names(folder)})
    finally:
        commits.clear(spark, base, run, folder)
