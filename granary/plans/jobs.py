"""Whole jobs: landed files to tables, and tables to published reports.

Ingest jobs check all rows into a staging folder in one pass and publish from there only if
none is invalid. Report jobs take the input tables as frames, so they work on any storage, or
as stored tables, whose days are known without a scan.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import schemas
from granary.functions import dates
from granary.operators import dimension, quality, snapshots
from granary.plans import customers, planning, publish, reporting
from granary.schemas import Entity
from granary.sources import commits, payloads, scans, sinks
from granary.sources.stored import PARTS, StoredTable
from granary.streaming import order_index


def staging_of(root: str) -> str:
    """Folder beside a table for rows on their way into it, on the same storage."""
    return commits.staging_of(root)


@contextmanager
def _checked_folder(spark: SparkSession, base: str) -> Iterator[str]:
    """A folder for the checked rows of this run alone. It stays only if the run fails, for
    its rejects to be read."""
    folder = f"{base.rstrip('/')}/run={commits.new_run()}"
    yield folder
    commits.drop(spark, folder)


def _store(df: DataFrame, entity: Entity, root: str, file_format: str, table: str | None) -> list[publish.Values]:
    """Replace the partitions present in ``df`` and register just these in the catalog."""
    rows = publish.conform(df, entity, with_partition=True)
    touched = publish.replace_partitions(rows, entity.partition_columns, root, file_format=file_format)
    if table and touched:
        publish.register_values(df.sparkSession, entity, table, touched)
    return touched


def ingest_orders(
    spark: SparkSession,
    landing: str | list[str],
    root: str,
    start: dt.date | str,
    end: dt.date | str,
    file_format: str = "parquet",
    table: str | None = None,
) -> None:
    """Landed order documents to daily order-line partitions for [start, end].

    Like all ingest jobs, registers the partitions it has written in the catalog table
    ``table``, if one is given.
    """
    docs = payloads.read_documents(spark, landing, "order")
    with _checked_folder(spark, f"{staging_of(root)}/checked") as folder:
        valid = quality.staged_valid(payloads.flatten_orders(docs), schemas.ORDER_DETAILS, folder)
        quality.require_complete(docs, "id", valid, "shipbob_order_id", f"{folder}.lost")
        daily = sinks.split_by_day(valid, "purchase_date", "order_date", start, end)
        _store(daily, schemas.ORDER_DETAILS, root, file_format, table)
        order_index.forget(spark, root)  # of the streaming refresh, which did not see these rows


def ingest_snapshot(
    rows: DataFrame, entity: Entity, root: str, day: dt.date | str, file_format: str = "parquet", table: str | None = None
) -> None:
    """Validated rows as the ``day`` partition of a snapshot table."""
    (column,) = entity.partition_columns
    with _checked_folder(rows.sparkSession, f"{staging_of(root)}/checked") as folder:
        valid = quality.staged_valid(rows, entity, folder)
        _store(valid.withColumn(column, dates.day_lit(day)), entity, root, file_format, table)


def ingest_inventory(spark, landing, root, day, file_format="parquet", table=None) -> None:
    docs = payloads.read_documents(spark, landing, "inventory")
    rows = payloads.project_inventory(docs)
    ingest_snapshot(rows, schemas.INVENTORY_DETAILS, root, day, file_format, table)


def ingest_active_variants(spark, landing, root, day, file_format="parquet", table=None) -> None:
    docs = payloads.read_documents(spark, landing, "store_product")
    rows = payloads.active_variants(docs)
    ingest_snapshot(rows, schemas.ACTIVE_VARIANT_SKUS, root, day, file_format, table)


def ingest_formulas(spark, export, root, day, file_format="parquet", table=None) -> None:
    rows = scans.read_formulas_export(spark, export)
    ingest_snapshot(rows, schemas.FORMULAS, root, day, file_format, table)


def ingest_material_inventory(spark, export, root, day, file_format="parquet", table=None) -> None:
    rows = scans.read_export(spark, export)
    ingest_snapshot(rows, schemas.MATERIAL_INVENTORY, root, day, file_format, table)


def ingest_manufacturing_orders(spark, export, root, day, file_format="parquet", table=None) -> None:
    rows = scans.read_export(spark, export)
    ingest_snapshot(rows, schemas.MANUFACTURING_ORDERS, root, day, file_format, table)


def ingest_store_orders(
    spark: SparkSession,
    landing: str | list[str],
    orders_root: str,
    lines_root: str,
    file_format: str = "parquet",
    orders_table: str | None = None,
    lines_table: str | None = None,
) -> None:
    """Storefront documents to header and line tables by year, month and day."""
    docs = payloads.read_documents(spark, landing, "store_order")
    targets = (
        (payloads.flatten_store_orders(docs), schemas.STORE_ORDERS, orders_root, orders_table),
        (payloads.flatten_store_line_items(docs), schemas.STORE_LINE_ITEMS, lines_root, lines_table),
    )
    with ExitStack() as folders:
        staged = []
        for rows, entity, root, table in targets:
            folder = folders.enter_context(_checked_folder(spark, f"{staging_of(root)}/checked"))
            staged.append((quality.staged_valid(rows, entity, folder), entity, root, table))
        for valid, entity, root, table in staged:
            _store(sinks.with_day_parts(valid, "order_date"), entity, root, file_format, table)


def ingest_campaigns(spark, landing, root, day) -> None:
    docs = payloads.read_documents(spark, landing, "campaign")
    sinks.write_json_lines(payloads.flatten_campaigns(docs), root, day)


def read_dimension(spark: SparkSession, root: str) -> DataFrame:
    """The stored product dimension with its buckets; without rows before the first change."""
    schema = schemas.PRODUCT_DIMENSION.struct(with_partition=True)
    if not commits.Files(spark, root).names(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def change_dimension(
    root: str,
    changes: DataFrame,
    at: dt.datetime,
    how: Callable[..., tuple[DataFrame, DataFrame]] = dimension.upsert,
    table: str | None = None,
    attempts: int = 10,
) -> DataFrame:
    """Merge changes into the stored product dimension; returns those that were rejected.

    ``how`` is ``dimension.upsert`` or ``dimension.insert``. Only buckets with a change are
    read, written and switched, all at once; the files of the others stay. If another run has
    changed one of them meanwhile, the merge is made again on the new rows. Changes without a
    key or a required attribute stop the job before anything is written. With ``table`` new
    buckets are registered in the catalog.
    """
    spark, entity = changes.sparkSession, schemas.PRODUCT_DIMENSION
    base, run = root.rstrip("/"), commits.new_run()
    form = dataclasses.replace(entity, fields=tuple(f for f in entity.fields if f.name in (dimension.KEY, *dimension.ATTRIBUTES)))
    with _checked_folder(spark, f"{staging_of(base)}/changes") as folder:
        valid = quality.staged_valid(changes.select(dimension.KEY, *dimension.ATTRIBUTES), form, folder)
        touched = sorted(r["bucket"] for r in valid.select(dimension.bucket()).distinct().collect())
        files = commits.Files(spark, base)
        for attempt in range(attempts):
            read = {f"{base}/bucket={b}": commits.version(files, f"{base}/bucket={b}") for b in touched}
            current = read_dimension(spark, base).filter(F.col("bucket").isin(touched)).drop("bucket")
            merged, rejected = how(current, valid, at)
            rows = publish.conform(merged.withColumn("bucket", dimension.bucket()), entity, with_partition=True)
            kept = f"{staging_of(base)}/rejected/run={run}-{attempt}"
            sinks.write_parquet(rejected, kept)
            try:
                replaced = publish.replace_partitions(rows, ["bucket"], base, read=read)
            except commits.ConflictError:
                commits.drop(spark, kept)
                if attempt + 1 == attempts:
                    raise
                continue
            if table and replaced:
                publish.register_values(spark, entity, table, replaced)
            return spark.read.schema(rejected.schema).parquet(kept)


Tables = Mapping[str, DataFrame | StoredTable]


def _rows(table: DataFrame | StoredTable) -> DataFrame:
    return table.rows() if isinstance(table, StoredTable) else table


def _newest(table: DataFrame | StoredTable, day: dt.date | str) -> DataFrame:
    """Rows of the newest partition on ``day``, with its date as a literal in the plan."""
    return table.newest_rows(day) if isinstance(table, StoredTable) else snapshots.stored_partition(table, day)


def _needed(table: DataFrame | StoredTable, start: dt.date, end: dt.date) -> DataFrame:
    """Rows among which each day of [start, end] finds its newest partition."""
    return table.between(table.newest(start) or start, end) if isinstance(table, StoredTable) else table


def _each_day(table: DataFrame | StoredTable, start: dt.date | str, end: dt.date | str) -> DataFrame:
    return table.each_day(start, end) if isinstance(table, StoredTable) else snapshots.each_day(table, start, end)


@dataclasses.dataclass(frozen=True)
class Report:
    """``build`` makes one day; ``build_range`` makes all days of a range in one plan, with
    the day in the table's partition column. Both see inputs as they were on the day."""

    entity: Entity
    build: Callable[[Tables, dt.date], DataFrame]
    build_range: Callable[[Tables, dt.date, dt.date], DataFrame] | None = None
    validated: bool = False


CURRENT_INVENTORY = dataclasses.replace(
    schemas.INVENTORY_DETAILS, name="current_inventory", comment="Newest stock snapshot"
)


def _retention(tables: Tables, day: dt.date) -> DataFrame:
    """Retention as of ``day``: from the customers' state, if the tables have that day's (see
    ``advance_customers``), otherwise from all orders known on the day."""
    state, left = (tables.get(e.name) for e in (schemas.CUSTOMER_DAYS, schemas.OPEN_HISTORY))
    if isinstance(state, StoredTable) and isinstance(left, StoredTable) and day in state.days():
        return customers.retention_by_cohort(customers.state_flags(state.on(day), left.on(day), day))
    return customers.retention_on(_rows(tables["historic_order_data"]), _rows(tables["order_details"]), day)


def advance_customers(tables: Tables, day: dt.date | str, rebuild: bool = False) -> None:
    """Bring the customers' state (``customer_days``, ``open_history``) to ``day``.

    Reads the newest state before ``day`` and the orders filed since, usually one day's. With
    ``rebuild``, or without an earlier state, all orders are read. Orders that were filed or
    corrected under days already merged need a rebuild.
    """
    day = dates.to_day(day)
    state, left = tables[schemas.CUSTOMER_DAYS.name], tables[schemas.OPEN_HISTORY.name]
    orders = _rows(tables["order_details"])
    # The state is written last, so a day with a state has its open history too.
    last = next((d for d in reversed(state.days()) if d < day), None)
    if last is None or rebuild:
        new = customers.begin_state(_rows(tables["historic_order_data"]), orders, day)
    else:
        since = orders.filter((F.col("order_date") > dates.day_lit(last)) & (F.col("order_date") <= dates.day_lit(day)))
        new = customers.advance_state(state.on(last), left.on(last), since)
    for table, rows in ((left, new[1]), (state, new[0])):
        publish.publish_partition(rows, table.entity, table.root, staging_of(table.root), day)
        if table.table:
            publish.register_days(table.spark, table.entity, table.table, day)


def _snapshot_report(entity: Entity, inputs: tuple[str, ...], build: Callable[..., DataFrame], **options) -> Report:
    """Report over the newest partition, on the run day, of each input.

    ``build`` takes the inputs and ``by``, the extra key of a range.
    """

    def one(tables: Tables, day: dt.date) -> DataFrame:
        # A range of one day: what is picked already is not searched for its newest day.
        days = [_newest(tables[n], day).withColumn("as_of", dates.day_lit(day)) for n in inputs]
        return build(*days, by=("as_of",)).drop("as_of")

    def many(tables: Tables, start: dt.date, end: dt.date) -> DataFrame:
        days = [_each_day(tables[n], start, end) for n in inputs]
        (column,) = entity.partition_columns
        return build(*days, by=("as_of",)).drop(column).withColumnRenamed("as_of", column)

    return Report(entity, one, many, **options)


REPORTS: dict[str, Report] = {
    "inventory_run_rate": Report(
        schemas.RUN_RATE,
        lambda t, day: planning.run_rate_with(
            _rows(t["order_details"]), _newest(t["inventory_details"], day - dt.timedelta(days=1)), day
        ),
        lambda t, start, end: planning.run_rate_range(
            _rows(t["order_details"]), _needed(t["inventory_details"], start - dt.timedelta(days=1), end), start, end
        ),
        validated=True,
    ),
    "raw_material_run_rate": _snapshot_report(
        schemas.RAW_MATERIAL_RUN_RATE,
        ("inventory_run_rate", "formulas", "material_inventory"),
        planning.raw_material_run_rate,
        validated=True,
    ),
    "raw_material_status": _snapshot_report(
        schemas.RAW_MATERIAL_STATUS,
        ("material_inventory", "open_manufacturing_orders"),
        planning.raw_material_status,
        validated=True,
    ),
    "daily_order_cnt_by_channel": Report(
        schemas.DAILY_ORDER_COUNT,
        lambda t, day: customers.daily_order_counts(_rows(t["order_details"]), day),
        lambda t, start, end: customers.daily_order_counts(_rows(t["order_details"]), start, end),
    ),
    "retention_by_cohort": Report(
        schemas.RETENTION,
        lambda t, day: _retention(t, day),
        lambda t, start, end: customers.retention_range(_rows(t["historic_order_data"]), _rows(t["order_details"]), start, end),
    ),
    "current_inventory": _snapshot_report(
        CURRENT_INVENTORY, ("inventory_details",), lambda stock, by=(): stock
    ),
    "inventory_run_rate_mart": _snapshot_report(
        schemas.RUN_RATE_MART, ("inventory_run_rate",), planning.run_rate_mart
    ),
    "all_line_item_obfuscated": Report(
        schemas.OBFUSCATED_LINE_ITEMS,
        lambda t, day: customers.obfuscated_line_items(
            _rows(t["historic_order_data"]), _rows(t["order_details"]), day
        ),
    ),
}


@contextmanager
def _checked(report: Report, rows: DataFrame, staging_root: str) -> Iterator[DataFrame]:
    """Rows of a validated report from a staging folder of this run, others as they are."""
    if not report.validated:
        yield rows
        return
    entity = dataclasses.replace(report.entity, fields=(*report.entity.fields, *report.entity.partition))
    keep = entity if all(c in rows.columns for c in entity.partition_columns) else report.entity
    with _checked_folder(rows.sparkSession, f"{staging_root.rstrip('/')}/{report.entity.name}.checked") as folder:
        yield quality.staged_valid(rows, keep, folder)


def run_report(
    name: str,
    tables: Tables,
    root: str,
    staging_root: str,
    run_date: dt.date | str | None = None,
    table: str | None = None,
) -> None:
    """Build a report and replace its day, or the whole table when it has no partitions.

    Without ``run_date`` the report of the day 24 hours ago is made. With ``table`` the day
    is registered in that catalog table.
    """
    report = REPORTS[name]
    day = dates.to_day(run_date or dates.report_day(dt.datetime.now(dt.timezone.utc)))
    rows = report.build(tables, day)
    if not report.entity.partition:
        publish.publish_full(rows, report.entity, root)
        return
    with _checked(report, rows.drop(*report.entity.partition_columns), staging_root) as valid:
        publish.publish_partition(valid, report.entity, root, staging_root, day)
    if table:
        publish.register_days(rows.sparkSession, report.entity, table, day)


def backfill_report(
    name: str,
    tables: Tables,
    root: str,
    staging_root: str,
    start: dt.date | str,
    end: dt.date | str,
    table: str | None = None,
) -> None:
    """Replace all days of [start, end] as one plan; days without rows become empty."""
    report = REPORTS[name]
    if report.build_range is None:
        raise ValueError(f"{name} has no days: it is replaced as a whole")
    rows = report.build_range(tables, dates.to_day(start), dates.to_day(end))
    with _checked(report, rows, staging_root) as valid:
        publish.replace_range(valid, report.entity, root, staging_root, start, end)
    if table:
        publish.register_days(rows.sparkSession, report.entity, table, start, end)


def publish_dashboard(tables: Tables, root: str, day: dt.date | str) -> list[str]:
    """Dashboard datasets and alert rows of one day, each below ``root/<name>/partition_date=...``.

    The run rates of the day are one small stored partition, so the datasets share no more
    than that. All of them are complete before any of the day is replaced.
    """
    rates = _newest(tables["inventory_run_rate"], day)
    frames = reporting.dashboard_datasets(_rows(tables["order_details"]), _rows(tables["inventory_details"]), rates, day)
    frames |= alerts(tables, day)
    base = root.rstrip("/")
    publish.replace_folders({publish.partition_path(f"{base}/{n}", "partition_date", day): rows for n, rows in frames.items()}, base)
    return sorted(frames)


def alerts(tables: Tables, day: dt.date | str) -> dict[str, DataFrame]:
    """Rows to act on, with their message lines, as the tables were on ``day``."""
    rates = _newest(tables["inventory_run_rate"], day)
    status = _newest(tables["raw_material_status"], day)
    return {
        "finished_goods_alerts": reporting.finished_goods_alerts(rates),
        "raw_material_alerts": reporting.raw_material_alerts(status),
    }


def missing_source_days(
    spark: SparkSession, entity: Entity, root: str, yesterday: dt.date | str, lookback_days: int = 7
) -> DataFrame:
    """Days an ingested table lacks within the lookback window; asked before reports run.

    Only the folders of the window's days are opened.
    """
    rows = _window(StoredTable(spark, root, entity), yesterday, lookback_days)
    if entity.partition_columns == PARTS:
        return snapshots.missing_dates(scans.with_day_from_parts(rows, "_day"), "_day", yesterday, lookback_days)
    (column,) = entity.partition_columns
    return snapshots.missing_dates(rows, column, yesterday, lookback_days)


def missing_report_days(
    spark: SparkSession, name: str, root: str, yesterday: dt.date | str, lookback_days: int = 7
) -> DataFrame:
    """Days a published report lacks within the lookback window."""
    return missing_source_days(spark, REPORTS[name].entity, root, yesterday, lookback_days)


def _window(table: StoredTable, yesterday: dt.date | str, lookback_days: int) -> DataFrame:
    last = dates.to_day(yesterday)
    return table.between(last - dt.timedelta(days=lookback_days - 1), last)
