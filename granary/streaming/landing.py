"""Landed order documents -> daily partitions of the order table.

Each micro-batch rewrites only the order days it touches: the days of its new rows and the
days that still hold rows of its orders. An order that was delivered again replaces its
earlier rows wherever they are, also when it moved to another day or lost its items. An index
of the days that hold an order (``order_index``) tells which days these are; no other day is
opened. The new days are staged as a whole before the table is touched, and a batch that is run
again applies what it had staged, so a failure at any point loses nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.operators import quality
from granary.plans import publish
from granary.schemas import ORDER_DETAILS
from granary.sources import payloads, scans, sinks
from granary.streaming import order_index
from granary.streaming.order_index import DAY, ORDER

READY = "batch_id long, emptied array<date>, number long"


def newest_delivery(docs: DataFrame) -> DataFrame:
    """Last delivered document per order id.

    ``max_by`` keeps one document per id and task before the shuffle, so an order
    delivered very often does not pile up in one place.
    """
    content = [c for c in docs.columns if c not in ("_delivered", "_file")]
    return (
        docs.groupBy("id")
        .agg(F.max_by(F.struct(*content), F.struct("_delivered", "_file")).alias("d"))
        .select("d.*")
    )


def _existing_rows(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return scans.read_parquet_table(spark, root, ORDER_DETAILS)
    except Exception as missing:  # first batch: no table yet
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def _staged(spark: SparkSession, staging: str, batch_id: int | None) -> tuple[list[dt.date], int] | None:
    """Days to empty and the index's number, if this batch was staged completely before."""
    try:
        ready = spark.read.schema(READY).parquet(f"{staging}/ready").first()
    except Exception as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    if ready is None or batch_id is None or ready["batch_id"] != batch_id:
        return None
    return list(ready["emptied"]), ready["number"]


def _days(rows: DataFrame) -> list[dt.date]:
    """Distinct days of rows, at most one for each calendar day."""
    return [r[DAY] for r in rows.select(DAY).distinct().collect()]


def stage_days(rows: DataFrame, orders: DataFrame, root: str, staging: str, batch_id: int | None) -> tuple[list[dt.date], int]:
    """Write the new content of all touched days to ``staging``; returns days left empty and
    the batch's number in the index.

    ``rows`` are the new lines with their day, ``orders`` the ids of all delivered orders,
    those without lines included.
    """
    spark = rows.sparkSession
    existing = _existing_rows(spark, root)
    refreshed, held = rows, []
    if existing is not None:
        if not order_index.exists(spark, root):
            order_index.build(spark, root)
        held = _days(order_index.days_of(spark, root, orders)) if order_index.exists(spark, root) else []
        # Days as literals, so other partitions are not even listed for reading.
        touched = sorted({*held, *_days(rows)})
        kept = existing.filter(F.col(DAY).isin(touched)).join(orders, ORDER, "left_anti")
        refreshed = kept.select(*rows.columns).unionByName(rows)
    sinks.write_parquet(refreshed, f"{staging}/days")
    emptied = sorted({*held} - {*_days(_staged_days(spark, staging))})
    number = order_index.next_batch(spark, root)
    ready = spark.createDataFrame([(batch_id, emptied, number)], READY)
    sinks.write_parquet(ready.coalesce(1), f"{staging}/ready")
    return emptied, number


def index_batch(spark: SparkSession, root: str, staging: str, number: int) -> None:
    """Enter the days that now hold the batch's orders, from what it has staged."""
    orders = _staged_orders(spark, staging)
    entries = orders.join(_staged_days(spark, staging).select(ORDER, DAY).distinct(), ORDER, "left")
    order_index.add(spark, root, entries, number)


def _staged_orders(spark: SparkSession, staging: str) -> DataFrame:
    return spark.read.schema(f"{ORDER} bigint").parquet(f"{staging}/orders")


def _staged_days(spark: SparkSession, staging: str) -> DataFrame:
    return spark.read.schema(ORDER_DETAILS.struct(with_partition=True)).parquet(f"{staging}/days")


def apply_days(spark: SparkSession, root: str, staging: str, emptied: list[dt.date]) -> None:
    """Replace the staged days of the table. Doing it twice equals doing it once."""
    rows = _staged_days(spark, staging)
    sinks.write_parquet_by(rows, root, [DAY])
    for day in emptied:
        publish.clear_day(rows, ORDER_DETAILS, root, day)


def refresh_batch(docs: DataFrame, root: str, staging: str, batch_id: int | None = None) -> None:
    spark = docs.sparkSession
    staged = _staged(spark, staging, batch_id)
    if staged is None:
        newest = newest_delivery(docs)
        # Ids come from the documents: an order may have lost its items.
        sinks.write_parquet(newest.select(F.col("id").alias(ORDER)), f"{staging}/orders")
        valid = quality.staged_valid(payloads.flatten_orders(newest), ORDER_DETAILS, f"{staging}/checked")
        rows = sinks.split_by_day(valid, "purchase_date", DAY)
        staged = stage_days(rows, _staged_orders(spark, staging), root, staging, batch_id)
    emptied, number = staged
    apply_days(spark, root, staging, emptied)
    index_batch(spark, root, staging, number)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Folder below the session's shared checkpoint directory."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("pass a checkpoint folder or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/{name}"


def start_refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Process all files landed since the last run, then stop.

    Progress is kept in ``checkpoint``, by default below the cluster's checkpoint folder;
    it has to be storage that every node can reach.
    """
    checkpoint = checkpoint or checkpoint_location(spark, "order_landing")
    staging = f"{checkpoint.rstrip('/')}.staging"
    docs = (
        spark.readStream.schema(" ".join(payloads.ORDER_DOC.split()))
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(landing)
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("_delivered"),
            F.col("_metadata.file_path").alias("_file"),
        )
    )
    return (
        docs.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: refresh_batch(batch, root, staging, batch_id))
        .start()
    )
