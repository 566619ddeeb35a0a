"""Failures and runs at the same time leave whole tables."""

import datetime as dt
import json
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.plans import jobs, publish
from granary.schemas import DAILY_ORDER_COUNT
from granary.sources import commits, scans
from tests.test_jobs import csv_export, land, stock_item
from tests.test_payloads import order, product, store_order, variant
from tests.test_tables import counts

DAY = dt.date(2024, 1, 1)
DAYS = [DAY + dt.timedelta(days=n) for n in range(4)]


def by_day(spark, value, *days):
    rows = counts(spark, (1, value))
    return rows.withColumn("order_date", F.explode(F.array(*[F.lit(d) for d in days])))


def table(spark, root):
    rows = scans.read_parquet_table(spark, root, DAILY_ORDER_COUNT).collect()
    return {r.order_date: r.order_cnt for r in rows}


def left_over(root):
    return [p for p in pathlib.Path(commits.staging_of(root)).rglob("*") if p.is_file() and not p.name.startswith(".")]


def boom(df):
    return df.withColumn("order_cnt", F.raise_error(F.lit("boom")).cast("bigint"))


WAYS = {
    "partition": lambda df, root: publish.publish_partition(df, DAILY_ORDER_COUNT, root, f"{root}.st", DAY),
    "range": lambda df, root: publish.replace_range(df.withColumn("order_date", F.lit(DAY)), DAILY_ORDER_COUNT, root, f"{root}.st", DAY, DAYS[1]),
    "days": lambda df, root: publish.publish_range(df.withColumn("order_date", F.lit(DAY)), DAILY_ORDER_COUNT, root),
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("step", ["build", "first rename", "second rename"])
def test_a_failure_leaves_the_old_days(spark, tmp_path, monkeypatch, way, step):
    root = str(tmp_path / "t")
    publish.publish_range(by_day(spark, 5, *DAYS), DAILY_ORDER_COUNT, root)
    fresh = counts(spark, (1, 9))
    with monkeypatch.context() as broken:
        if step != "build":
            break_rename(broken, 1 if step == "first rename" else 2)
        with pytest.raises(Exception, match="boom"):
            WAYS[way](boom(fresh) if step == "build" else fresh, root)
    assert table(spark, root) == dict.fromkeys(DAYS, 5)
    assert left_over(root) == []
    WAYS[way](fresh, root)
    assert table(spark, root) == {d: 9 if d == DAY else 5 for d in DAYS if way != "range" or d != DAYS[1]}


def break_rename(patch, which, error=RuntimeError):
    """The ``which``-th rename fails; ``error`` may be what kills a driver."""
    real, seen = commits.Files.rename, []

    def rename(self, old, new):
        seen.append(old)
        if len(seen) == which:
            raise error("boom")
        real(self, old, new)

    patch.setattr(commits.Files, "rename", rename)


@pytest.mark.parametrize("which", [1, 2, 3, 4, 5])
def test_a_whole_table_or_several_days_switch_together(spark, tmp_path, monkeypatch, which):
    root = str(tmp_path / "t")
    publish.publish_range(by_day(spark, 5, *DAYS), DAILY_ORDER_COUNT, root)
    with monkeypatch.context() as broken:
        break_rename(broken, which)
        with pytest.raises(RuntimeError, match="boom"):
            publish.publish_range(by_day(spark, 9, *DAYS), DAILY_ORDER_COUNT, root)
    assert table(spark, root) == dict.fromkeys(DAYS, 5)
    full = str(tmp_path / "full")
    publish.publish_full(counts(spark, (1, 5)), DAILY_ORDER_COUNT, full)
    with monkeypatch.context() as broken:
        break_rename(broken, 1 + which % 2)
        with pytest.raises(RuntimeError, match="boom"):
            publish.publish_full(counts(spark, (3, 7)), DAILY_ORDER_COUNT, full)
    with pytest.raises(Exception, match="boom"):
        publish.publish_full(boom(counts(spark, (3, 7))), DAILY_ORDER_COUNT, full)
    assert [tuple(r) for r in spark.read.parquet(full).collect()] == [("1", "ch 1", 5)]
    publish.publish_full(spark.read.parquet(full).withColumn("order_cnt", F.lit(8)), DAILY_ORDER_COUNT, full)
    assert [tuple(r) for r in spark.read.parquet(full).collect()] == [("1", "ch 1", 8)]


@pytest.mark.parametrize("which", [1, 2, 3, 6])
def test_what_a_dead_driver_began_is_finished(spark, tmp_path, monkeypatch, which):
    root = str(tmp_path / "t")
    publish.publish_range(by_day(spark, 5, *DAYS), DAILY_ORDER_COUNT, root)
    with monkeypatch.context() as broken:
        break_rename(broken, which, KeyboardInterrupt)
        with pytest.raises(KeyboardInterrupt):
            publish.publish_range(by_day(spark, 9, *DAYS[:3]), DAILY_ORDER_COUNT, root)
    commits.recover(spark, root)
    assert table(spark, root) == {d: 5 if d == DAYS[3] else 9 for d in DAYS}
    assert not [p for p in left_over(root) if p.suffix == ".json"]
    commits.recover(spark, str(tmp_path / "no table"))


def test_a_manifest_without_its_files_switches_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    publish.publish_range(by_day(spark, 5, DAY), DAILY_ORDER_COUNT, root)
    staged = tmp_path / "staged"
    staged.mkdir()
    (staged / "a.parquet").write_text("half")
    log = pathlib.Path(commits.staging_of(root), "_commits")
    entry = {"target": f"{root}/order_date=2024-01-01", "staged": str(staged), "old": f"{staged}.old", "files": {"a.parquet": 400}}
    (log / "dead.json").write_text(json.dumps({"folders": [entry]}))
    with pytest.raises(OSError, match="files that its run has listed"):
        commits.recover(spark, root)
    assert table(spark, root) == {DAY: 5}
    (log / "dead.json").write_text('{"folders": [')
    commits.recover(spark, root)
    assert table(spark, root) == {DAY: 5} and not (log / "dead.json").exists()


def test_runs_at_once_keep_apart(spark, tmp_path):
    """Back-fills of different and of the same days, through one staging folder."""
    root, staging, errors = str(tmp_path / "t"), str(tmp_path / "st"), []

    def run(value, days):
        try:
            for _ in range(2):
                publish.replace_range(by_day(spark, value, *days), DAILY_ORDER_COUNT, root, staging, days[0], days[-1])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=a) for a in ((1, DAYS[:2]), (2, DAYS[2:3]), (3, DAYS[3:]), (4, DAYS[3:]))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    rows = scans.read_parquet_table(spark, root, DAILY_ORDER_COUNT).collect()
    assert len(rows) == 4 and {r.order_date: r.order_cnt for r in rows if r.order_date != DAYS[3]} == {DAYS[0]: 1, DAYS[1]: 1, DAYS[2]: 2}
    assert table(spark, root)[DAYS[3]] in (3, 4)


def test_locks(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    log = pathlib.Path(commits.staging_of(root), "_commits")
    log.mkdir(parents=True)
    (log / "lock").write_text("somebody")
    monkeypatch.setattr(commits, "PATIENCE", 0.5)
    with pytest.raises(TimeoutError, match="another run holds"):
        publish.publish_range(by_day(spark, 5, DAY), DAILY_ORDER_COUNT, root)
    assert (log / "lock").read_text() == "somebody" and not pathlib.Path(root).exists()
    # Left by a dead driver.
    monkeypatch.setattr(commits, "STALE", -1.0)
    publish.publish_range(by_day(spark, 5, DAY), DAILY_ORDER_COUNT, root)
    assert table(spark, root) == {DAY: 5} and not (log / "lock").exists()


def test_a_failing_dashboard_leaves_all_datasets(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "d")
    frames = lambda *values: {n: counts(spark, (1, v)) for n, v in zip("abc", values, strict=True)}

    def published(which):
        monkeypatch.setattr(jobs.reporting, "dashboard_datasets", lambda *a: which)
        monkeypatch.setattr(jobs, "alerts", lambda *a: {})
        rates = spark.range(1).select(F.lit(DAY).alias("partition_date"))
        return jobs.publish_dashboard({"inventory_run_rate": rates, "order_details": None, "inventory_details": None}, root, DAY)

    read = lambda: {n: spark.read.parquet(f"{root}/{n}").first().order_cnt for n in "abc"}
    assert published(frames(1, 2, 3)) == ["a", "b", "c"]
    late = frames(4, 5, 6)
    late["c"] = boom(late["c"])
    with pytest.raises(Exception, match="boom"):
        published(late)
    assert read() == {"a": 1, "b": 2, "c": 3}
    with monkeypatch.context() as broken:
        break_rename(broken, 4)
        with pytest.raises(RuntimeError, match="boom"):
            published(frames(4, 5, 6))
    assert read() == {"a": 1, "b": 2, "c": 3}
    published(frames(7, 8, 9))
    assert read() == {"a": 7, "b": 8, "c": 9}


def shown(spark, name):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def test_ingest_jobs_register_what_they_wrote(spark, tmp_path):
    """After each job its catalog table shows the partitions it has written, and no others:
    a folder that somebody put there stays unlisted."""
    shipments = [{"products": [product(1, 11, 12)]}]
    web = {"id": 1, "name": "web"}
    listed = {"id": 1, "title": "a", "published_at": "2024-01-01T10:00:00-05:00", "variants": [variant(1, 3)]}
    recipe = csv_export(tmp_path, "r.csv", ",".join(f"H{i}" for i in range(14)), "11,n,,,,RM-1,Flour,,,,,0.5,kg,1.25")
    materials = csv_export(
        tmp_path, "m.csv", ",".join(schemas.MATERIAL_INVENTORY.columns).replace("_", " ").title(), "Flour,RM-1,,,kg,1,2,30,0,0,0,30,Main"
    )
    mos = csv_export(
        tmp_path, "o.csv", ",".join(schemas.MANUFACTURING_ORDERS.columns).replace("_", " ").title(),
        "M1,2024-10-01,,OPEN,11,p,4,,pcs,RM-1,Flour,,40,,kg,2,NOT",
    )
    orders = land(tmp_path, "orders.json", order(1, shipments, web))
    store = land(tmp_path, "store.json", store_order(1))
    day = "2024-10-27"
    runs = {
        schemas.ORDER_DETAILS: lambda root, name: jobs.ingest_orders(spark, orders, root, "2024-10-01", day, table=name),
        schemas.INVENTORY_DETAILS: lambda root, name: jobs.ingest_inventory(spark, land(tmp_path, "s.json", stock_item(11, 8)), root, day, table=name),
        schemas.ACTIVE_VARIANT_SKUS: lambda root, name: jobs.ingest_active_variants(spark, land(tmp_path, "v.json", listed), root, day, table=name),
        schemas.FORMULAS: lambda root, name: jobs.ingest_formulas(spark, recipe, root, day, table=name),
        schemas.MATERIAL_INVENTORY: lambda root, name: jobs.ingest_material_inventory(spark, materials, root, day, table=name),
        schemas.MANUFACTURING_ORDERS: lambda root, name: jobs.ingest_manufacturing_orders(spark, mos, root, day, table=name),
        schemas.STORE_ORDERS: lambda root, name: jobs.ingest_store_orders(spark, store, root, f"{root}_l", orders_table=name, lines_table="reg_lines"),
    }
    publish.create_table(spark, schemas.STORE_LINE_ITEMS, "reg_lines", str(tmp_path / "store_orders_l"))
    for entity, run in runs.items():
        name, root = f"reg_{entity.name}", str(tmp_path / entity.name)
        publish.create_table(spark, entity, name, root)
        column = entity.partition_columns[0]
        pathlib.Path(root, f"{column}=1999-01-01").mkdir(parents=True)
        run(root, name)
        days = shown(spark, name)
        assert len(days) == 1 and not any("1999" in d for d in days), entity.name
        assert spark.table(name).count() > 0
        spark.sql(f"DROP TABLE {name}")
    assert shown(spark, "reg_lines") == {"year=2024/month=10/day=26"} or len(shown(spark, "reg_lines")) == 1
    assert spark.table("reg_lines").count() == 1
    spark.sql("DROP TABLE reg_lines")
