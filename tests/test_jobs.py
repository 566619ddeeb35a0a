"""Landed files to published reports, end to end."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.operators import quality
from granary.plans import jobs, reporting
from granary.sources import scans
from tests.test_payloads import order, product, store_order, variant

DAY = dt.date(2024, 10, 27)


def land(tmp_path, name, *documents):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def stock_item(item, quantity):
    kinds = {"bigint": quantity, "string": f"item {item}", "boolean": True}
    return {f.name: kinds[f.type] for f in schemas.INVENTORY_DETAILS.fields} | {"id": item, "lots": []}


def csv_export(tmp_path, name, header, *lines):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("flow")
    root = lambda name: str(tmp / "tables" / name)
    shipments = [{"products": [product(1, 11, 12)]}]
    web = {"id": 1, "name": "web"}
    orders = land(tmp, "orders.json", order(1, shipments, web), order(2, shipments, web))
    jobs.ingest_orders(spark, orders, root("order_details"), "2024-10-01", DAY)
    jobs.ingest_inventory(
        spark, land(tmp, "stock.json", stock_item(11, 8), stock_item(99, 5)), root("inventory_details"), "2024-10-26"
    )
    listed = {"id": 1, "title": "a", "published_at": "2024-01-01T10:00:00-05:00", "variants": [variant(1, 3)]}
    jobs.ingest_active_variants(spark, land(tmp, "variants.json", listed), root("active_variant_skus"), DAY)
    recipe = csv_export(
        tmp, "recipes.csv", ",".join(f"H{i}" for i in range(14)),
        "11,n,,,,RM-1,Flour,,,,,0.5,kg,1.25", "12,n,,,,RM-1,Flour,,,,,2,kg,1.25",
    )
    jobs.ingest_formulas(spark, recipe, root("formulas"), DAY)
    materials = csv_export(
        tmp, "materials.csv",
        "Name,Variant code / SKU,Category,Default supplier,Units of measure,Average cost,Value in stock,"
        "In stock,Expected,Committed,Safety stock,Calculated stock,Location",
        "Flour,RM-1,,,kg,1,2,30,0,0,0,30,Main",
    )
    jobs.ingest_material_inventory(spark, materials, root("material_inventory"), DAY)
    mos = csv_export(
        tmp, "mos.csv", ",".join(schemas.MANUFACTURING_ORDERS.columns).replace("_", " ").title(),
        "M1,2024-10-01,,OPEN,11,p,4,,pcs,RM-1,Flour,,40,,kg,2,NOT",
    )
    jobs.ingest_manufacturing_orders(spark, mos, root("open_manufacturing_orders"), DAY)
    names = ("order_details", "inventory_details", "formulas", "material_inventory", "open_manufacturing_orders")
    tables = {n: scans.read_parquet_table(spark, root(n), schemas.ENTITIES[n]) for n in names}
    tables["historic_order_data"] = tables["order_details"].filter("false")
    return tmp, root, tables


def report(spark, warehouse, name, day=DAY):
    tmp, root, tables = warehouse
    jobs.run_report(name, tables, root(name), str(tmp / "staging"), day)
    return scans.read_parquet_table(spark, root(name), jobs.REPORTS[name].entity)


def test_ingested_tables(warehouse):
    _, _, tables = warehouse
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {"order_details": 4, "inventory_details": 2, "formulas": 2, "material_inventory": 1,
                      "open_manufacturing_orders": 1, "historic_order_data": 0}
    assert tables["material_inventory"].first().category is None
    assert tables["open_manufacturing_orders"].first().done_date is None


def test_planning_chain(spark, warehouse):
    tables = warehouse[2]
    rates = report(spark, warehouse, "inventory_run_rate")
    got = {r.inventory_id: r for r in rates.collect()}
    # Quantities 1 and 2, twice each, on the one day there is.
    assert (got[11].run_rate, got[12].run_rate) == (2.0, 4.0)
    assert (got[11].est_stock_days_on_hand, got[11].name) == (4.0, "item 11")
    tables["inventory_run_rate"] = rates
    (need,) = report(spark, warehouse, "raw_material_run_rate").collect()
    assert (need.daily_run_rate, need.days_on_hand, need.reorder_point) == (9.0, 30 / 9, 540.0)
    status = report(spark, warehouse, "raw_material_status")
    (alert,) = reporting.raw_material_alerts(status).collect()
    assert (alert.name, alert.shortage) == ("Flour", 10)
    assert report(spark, warehouse, "inventory_run_rate_mart").count() == 2
    finished = reporting.finished_goods_alerts(rates).collect()
    assert {r.inventory_id: r.quantity_to_restock for r in finished} == {11: 172, 12: 360}


def test_customer_reports(spark, warehouse):
    assert report(spark, warehouse, "daily_order_cnt_by_channel").first().order_cnt == 2
    assert report(spark, warehouse, "retention_by_cohort").first().total_customers == 1
    assert report(spark, warehouse, "current_inventory").count() == 2
    hidden = report(spark, warehouse, "all_line_item_obfuscated")
    assert {r.customer_email_masked for r in hidden.collect()} == {"***@shop.com"}


def test_backfill_and_gaps(spark, warehouse):
    tmp, _, tables = warehouse
    root = str(tmp / "backfilled")
    start, end = DAY - dt.timedelta(days=2), DAY + dt.timedelta(days=1)
    jobs.backfill_report("inventory_run_rate", tables, root, str(tmp / "staging3"), start, end)
    days = [r[0] for r in jobs.missing_report_days(spark, "inventory_run_rate", root, end, 4).orderBy("missing_date").collect()]
    # No sales before DAY, so no rates for the two days before it.
    assert days == [DAY - dt.timedelta(days=2), DAY - dt.timedelta(days=1)]
    with pytest.raises(ValueError, match="replaced as a whole"):
        jobs.backfill_report("all_line_item_obfuscated", tables, root, str(tmp / "staging3"), DAY, DAY)
    gaps = jobs.missing_source_days(spark, schemas.ORDER_DETAILS, warehouse[1]("order_details"), DAY, 2)
    assert [r[0] for r in gaps.collect()] == [DAY - dt.timedelta(days=1)]


def snapshots_of(df, *days):
    """The rows once for each day, with quantities that tell the days apart."""
    return df.drop("partition_date").crossJoin(
        df.sparkSession.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "partition_date date, n int")
    )


def test_a_range_equals_its_days(spark, warehouse):
    tmp, _, tables = warehouse
    day = lambda n: DAY + dt.timedelta(days=n)
    rates = jobs.REPORTS["inventory_run_rate"].build(tables, DAY)
    later = dict(tables)
    # Partitions on three days; rows after a run day must not reach it.
    later["inventory_run_rate"] = snapshots_of(rates, day(0), day(2), day(5)).withColumn("run_rate", F.col("run_rate") * F.col("n")).drop("n")
    for name, column in (("formulas", "quantity_required"), ("material_inventory", "in_stock"),
                         ("open_manufacturing_orders", "planned_quantity_of_ingredient"),
                         ("inventory_details", "total_fulfillable_quantity")):
        later[name] = snapshots_of(tables[name], day(-1), day(1), day(4)).withColumn(column, F.col(column) * F.col("n")).drop("n")
    for name, report in jobs.REPORTS.items():
        if report.build_range is None:
            continue
        (column,) = report.entity.partition_columns
        whole = jobs.publish.conform(report.build_range(later, day(0), day(3)), report.entity, with_partition=True)
        got = sorted(map(repr, whole.collect()))
        expected = []
        for n in range(4):
            one = report.build(later, day(n)).drop(column).withColumn(column, F.lit(day(n)))
            expected += map(repr, jobs.publish.conform(one, report.entity, with_partition=True).collect())
        assert got == sorted(expected) and got, name


def test_a_backfill_checks_rows_and_empties_days(spark, warehouse):
    tmp, _, tables = warehouse
    root, staging = str(tmp / "counts"), str(tmp / "staging4")
    old = spark.createDataFrame([("9", "old", 1, DAY), ("9", "old", 1, DAY - dt.timedelta(days=1)), ("9", "old", 1, DAY - dt.timedelta(days=5))],
                                "channel_id string, channel_name string, order_cnt bigint, order_date date")
    jobs.publish.publish_range(old, schemas.DAILY_ORDER_COUNT, root)
    jobs.backfill_report("daily_order_cnt_by_channel", tables, root, staging, DAY - dt.timedelta(days=2), DAY)
    table = scans.read_parquet_table(spark, root, schemas.DAILY_ORDER_COUNT)
    assert {(r.channel_name, r.order_date) for r in table.collect()} == {("web", DAY), ("old", DAY - dt.timedelta(days=5))}
    broken = dict(tables)
    broken["order_details"] = tables["order_details"].withColumn("inventory_id", F.lit(None).cast("bigint"))
    rates = str(tmp / "broken")
    with pytest.raises(quality.InvalidRowsError, match="inventory_id: required"):
        jobs.backfill_report("inventory_run_rate", broken, rates, staging, DAY, DAY)
    assert not (tmp / "broken").exists()
    rejects = spark.read.parquet(f"{staging}/inventory_run_rate.checked").filter("rejected = 'true'")
    assert rejects.count() == 1


def test_dashboard_and_alerts_are_published(spark, warehouse):
    tmp, _, tables = warehouse
    stored = dict(tables)
    stored["inventory_run_rate"] = snapshots_of(jobs.REPORTS["inventory_run_rate"].build(tables, DAY), DAY).drop("n")
    stored["raw_material_status"] = snapshots_of(jobs.REPORTS["raw_material_status"].build(tables, DAY), DAY).drop("n")
    root = str(tmp / "dashboard")
    for _ in range(2):
        names = jobs.publish_dashboard(stored, root, DAY)
    back = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    assert {r.inventory_id for r in back["finished_goods_alerts"].collect()} == {11, 12}
    assert [r.name for r in back["raw_material_alerts"].collect()] == ["Flour"]
    assert back["inventory_status"].count() == back["product_cards"].count() == 2
    assert {"metric_bounds", "product_options", "stock_trend", "stock_trend_bounds", "sales_vs_run_rate", "product_daily_series"} <= set(names)


def test_a_job_registers_its_days(spark, warehouse):
    tmp, _, tables = warehouse
    root = str(tmp / "registered")
    jobs.publish.create_table(spark, schemas.DAILY_ORDER_COUNT, "registered_counts", root)
    jobs.run_report("daily_order_cnt_by_channel", tables, root, str(tmp / "staging5"), DAY, table="registered_counts")
    assert spark.table("registered_counts").first().order_date == DAY
    spark.sql("DROP TABLE registered_counts")


def test_default_run_date_is_yesterday(spark, warehouse):
    tmp, root, tables = warehouse
    jobs.run_report("daily_order_cnt_by_channel", tables, str(tmp / "default"), str(tmp / "staging2"))
    (partition,) = [p.name for p in (tmp / "default").iterdir() if p.is_dir()]
    assert partition.startswith("order_date=20")


def test_store_orders(spark, tmp_path):
    landing = land(tmp_path, "store.json", store_order(1), store_order(2, email="", shipping_address=None))
    jobs.ingest_store_orders(spark, landing, str(tmp_path / "o"), str(tmp_path / "l"), "csv")
    headers = scans.read_csv_table(spark, str(tmp_path / "o"), schemas.STORE_ORDERS)
    assert {r.email for r in headers.collect()} == {"a@b.co", "unknown@unknown.com"}
    line = scans.read_csv_table(spark, str(tmp_path / "l"), schemas.STORE_LINE_ITEMS).first()
    assert (line.sku, line.price, line.month) == ("No SKU", 5.0, "10")


def test_campaigns(spark, tmp_path):
    landing = land(tmp_path, "c.json", {"id": "1", "attributes": {"name": "n"}})
    jobs.ingest_campaigns(spark, landing, str(tmp_path / "campaigns"), DAY)
    assert (tmp_path / "campaigns" / "load_dt=2024-10-27").is_dir()


def test_an_invalid_row_stops_an_ingest(spark, tmp_path):
    landing = land(tmp_path, "stock.json", stock_item(1, 5) | {"name": None})
    with pytest.raises(quality.InvalidRowsError, match="name: required"):
        jobs.ingest_inventory(spark, landing, str(tmp_path / "t"), DAY)
    assert not (tmp_path / "t").exists()
    shipments = [{"products": [product(1, 11)]}]
    incomplete = land(tmp_path, "orders.json", order(1, shipments, {"id": 1, "name": "w"}), order(2, []))
    with pytest.raises(ValueError, match="2 documents but 1"):
        jobs.ingest_orders(spark, incomplete, str(tmp_path / "o"), DAY, DAY)
