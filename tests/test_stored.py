"""Days of stored tables come from metadata; other days' files stay closed."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from granary import schemas
from granary.operators import snapshots
from granary.plans import jobs, publish
from granary.sources import scans
from granary.sources.stored import StoredTable
from tests.test_jobs import DAY, snapshots_of, warehouse  # noqa: F401

day = lambda n: DAY + dt.timedelta(days=n)


def spoil(root, *keep):
    """Make files of all partitions unreadable but for those named."""
    for file in pathlib.Path(root).rglob("*.parquet"):
        if not any(str(k) in str(file) for k in keep):
            file.write_bytes(b"not a table")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def stored(spark, tables, tmp_path, *days):
    """The warehouse's snapshots as tables by day, with quantities that tell days apart."""
    out = {n: t for n, t in tables.items() if n in ("order_details", "historic_order_data")}
    columns = {"formulas": "quantity_required", "material_inventory": "in_stock", "open_manufacturing_orders": "planned_quantity_of_ingredient",
               "inventory_details": "total_fulfillable_quantity"}
    for name, column in columns.items():
        entity, root = schemas.ENTITIES[name], str(tmp_path / name)
        rows = snapshots_of(tables[name], *days).withColumn(column, F.col(column) * F.col("n"))
        publish.publish_range(rows, entity, root)
        out[name] = StoredTable(spark, root, entity)
    return out


def test_days_and_rows(spark, tmp_path, warehouse):  # noqa: F811
    table = stored(spark, warehouse[2], tmp_path, day(-3), day(-1), day(2))["inventory_details"]
    assert table.days() == [day(-3), day(-1), day(2)]
    assert (table.newest(day(-4)), table.newest(day(-1)), table.newest(day(1)), table.newest(day(9))) == (None, day(-1), day(-1), day(2))
    assert table.newest_rows(day(-4)).count() == 0 and table.newest_rows(day(0)).first().partition_date == day(-1)
    # An emptied day has a folder but no rows.
    publish.clear_day(table.on(day(-1)), schemas.INVENTORY_DETAILS, table.root, day(-1))
    assert table.newest(day(0)) == day(-3) and len(table.days()) == 3
    whole = scans.read_parquet_table(spark, table.root, schemas.INVENTORY_DETAILS)
    for start, end in ((day(-4), day(4)), (day(-2), day(1)), (day(-9), day(-5))):
        kept = lambda df: sorted(map(repr, df.select("id", "partition_date", "as_of", "total_fulfillable_quantity").collect()))
        assert kept(table.each_day(start, end)) == kept(snapshots.each_day(whole, start, end))
    none = StoredTable(spark, str(tmp_path / "none"), schemas.INVENTORY_DETAILS)
    assert none.days() == [] and none.newest(DAY) is None and none.each_day(DAY, DAY).count() == 0


def test_days_of_the_catalog(spark, tmp_path):
    root = str(tmp_path / "counts")
    publish.create_table(spark, schemas.DAILY_ORDER_COUNT, "stored_counts", root)
    rows = spark.createDataFrame([("1", "a", 1, DAY), ("1", "a", 1, day(1))], "channel_id string, channel_name string, order_cnt bigint, order_date date")
    publish.publish_range(rows, schemas.DAILY_ORDER_COUNT, root)
    table = StoredTable(spark, root, schemas.DAILY_ORDER_COUNT, "stored_counts")
    assert table.days() == []
    publish.register_days(spark, schemas.DAILY_ORDER_COUNT, "stored_counts", DAY)
    assert table.days() == [DAY] and table.newest(day(5)) == DAY
    spark.sql("DROP TABLE stored_counts")


def test_reports_open_one_partition_of_their_snapshots(spark, tmp_path, warehouse):  # noqa: F811
    """Files of all other days cannot even be read."""
    frames = warehouse[2]
    tables = stored(spark, frames, tmp_path, day(-9), day(-5), day(-1), day(1))
    plain = {n: t.rows() if isinstance(t, StoredTable) else t for n, t in tables.items()}
    rates = snapshots_of(jobs.REPORTS["inventory_run_rate"].build(plain, DAY), day(-2), day(0)).drop("n")
    publish.publish_range(rates, schemas.RUN_RATE, str(tmp_path / "rates"))
    tables["inventory_run_rate"] = StoredTable(spark, str(tmp_path / "rates"), schemas.RUN_RATE)
    plain["inventory_run_rate"] = tables["inventory_run_rate"].rows()
    names = ("inventory_run_rate", "raw_material_run_rate", "raw_material_status", "current_inventory", "inventory_run_rate_mart")
    expected = {n: sorted(map(repr, jobs.publish.conform(jobs.REPORTS[n].build(plain, DAY), jobs.REPORTS[n].entity).collect())) for n in names}
    for n in names:
        if n in plain:
            spoil(tmp_path / n, day(0))
    for n in ("formulas", "material_inventory", "open_manufacturing_orders", "inventory_details"):
        spoil(tmp_path / n, day(-1))
    spoil(tmp_path / "rates", day(0))
    for n in names:
        built = jobs.REPORTS[n].build(tables, DAY)
        assert sorted(map(repr, jobs.publish.conform(built, jobs.REPORTS[n].entity).collect())) == expected[n] != [], n
        opened = {pathlib.Path(f).parent.name for f in built.inputFiles() if "/order_details/" not in f}
        assert opened <= {f"partition_date={day(-1)}", f"partition_date={day(0)}"}, n


def test_gaps_open_the_window_only(spark, tmp_path, warehouse):  # noqa: F811
    table = stored(spark, warehouse[2], tmp_path, day(-30), day(-3), day(-1))["inventory_details"]
    spoil(table.root, day(-3), day(-1))
    gaps = jobs.missing_source_days(spark, schemas.INVENTORY_DETAILS, table.root, day(0), 5)
    assert sorted(r[0] for r in gaps.collect()) == [day(-4), day(-2), day(0)]
