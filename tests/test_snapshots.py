import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.operators import membership, snapshots
from granary.schemas import INVENTORY_DETAILS
from granary.sources import scans, sinks

D = dt.date


@pytest.fixture
def stock(spark):
    return spark.createDataFrame(
        [(1, D(2024, 1, 1)), (1, D(2024, 1, 5)), (2, D(2024, 1, 5)), (1, D(2024, 1, 9))],
        "id bigint, partition_date date",
    )


def test_latest_and_as_of(stock, rows):
    assert rows(snapshots.latest_partition(stock)) == [(1, D(2024, 1, 9))]
    assert rows(snapshots.latest_partition(stock, as_of="2024-01-08"), "id") == [
        (1, D(2024, 1, 5)), (2, D(2024, 1, 5)),
    ]
    assert rows(snapshots.snapshot_before(stock, "2024-01-05")) == [(1, D(2024, 1, 1))]
    assert rows(snapshots.snapshot_before(stock, "2024-01-01")) == []


def test_unpartitioned_frame_passes_through(stock, rows):
    plain = stock.drop("partition_date")
    assert len(rows(snapshots.latest_if_partitioned(plain))) == 4
    assert len(rows(snapshots.latest_if_partitioned(stock))) == 1


def test_calendar_agrees_with_snapshot_before(stock, rows):
    start, end = D(2024, 1, 1), D(2024, 1, 12)
    mapped = dict(rows(snapshots.snapshot_calendar(stock, start, end)))
    day = start
    while day <= end:
        picked = {r[1] for r in rows(snapshots.snapshot_before(stock, day))}
        assert picked == ({mapped[day]} if day in mapped else set()), day
        day += dt.timedelta(days=1)


def test_stored_partitions_are_pruned_by_the_subquery(spark, tmp_path, stock):
    path = str(tmp_path / "stock")
    sinks.write_parquet_by(stock, path, ["partition_date"])
    latest = snapshots.latest_partition(spark.read.parquet(path))
    plan = latest._jdf.queryExecution().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters: [" in line]
    assert any("Subquery" in line.split("PartitionFilters:")[1] or "scalar-subquery" in line for line in filters)
    assert latest.count() == 1


def test_the_newest_date_is_found_without_opening_the_history(spark, tmp_path, rows):
    path = tmp_path / "stock"
    days = [D(2022, 1, 1), D(2024, 1, 5), D(2024, 3, 9), D(2024, 3, 12)]
    for d in days:
        sinks.write_parquet(spark.createDataFrame([(1,)], "id bigint"), str(path / f"partition_date={d}"))
    # A file that cannot be opened: any search that reads it fails.
    for d in (days[0], days[3]):
        for f in (path / f"partition_date={d}").glob("*.parquet"):
            f.write_bytes(b"not a table")
        for f in (path / f"partition_date={d}").glob(".*.crc"):
            f.write_bytes(b"")
    table = spark.read.schema("id bigint, partition_date date").parquet(str(path))
    assert snapshots.newest_date(table, "2024-03-11") == days[2]
    # Nothing in the last days: the search widens step by step.
    assert snapshots.newest_date(table, "2024-01-30") == days[1]
    assert rows(snapshots.stored_partition(table, "2024-03-11")) == [(1, days[2])]
    none = spark.createDataFrame([], "id bigint, partition_date date")
    assert snapshots.newest_date(none, "2024-03-11") is None and snapshots.stored_partition(none, "2024-03-11").count() == 0


def test_missing_dates_at_both_ends_and_inside(spark, rows):
    present = spark.createDataFrame(
        [(D(2024, 1, 3),), (D(2024, 1, 3),), (D(2024, 1, 5),), (D(2023, 1, 1),)], "day date"
    )
    got = [r[0].day for r in rows(snapshots.missing_dates(present, "day", "2024-01-07"), "missing_date")]
    assert got == [1, 2, 4, 6, 7]


def test_all_days_missing_from_an_empty_table(spark):
    empty = spark.createDataFrame([], "day date")
    assert snapshots.missing_dates(empty, "day", "2024-01-07").count() == 7
    assert snapshots.missing_dates(empty, "day", "2024-01-07", 14).count() == 14


def test_missing_dates_per_source(spark, rows):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("b", D(2024, 1, 2)), ("c", D(2020, 1, 1))],
        "src string, day date",
    ).withColumnRenamed("day", "missing_date")
    got = rows(snapshots.missing_dates_by(df, "src", "missing_date", "2024-01-02", 2), "src", "missing_date")
    assert got == [("b", D(2024, 1, 1)), ("c", D(2024, 1, 1)), ("c", D(2024, 1, 2))]


def test_slices_and_probes(stock, rows):
    assert len(rows(scans.date_slice(stock, "partition_date", "2024-01-01", "2024-01-05"))) == 3
    assert dict(rows(scans.rows_per_date(stock, "partition_date")))[D(2024, 1, 5)] == 2
    assert scans.has_rows_on(stock, "partition_date", "2024-01-09")
    assert not scans.has_rows_on(stock, "partition_date", "2024-01-02")


def test_membership_flag_handles_nulls(spark, rows):
    orders = spark.createDataFrame(
        [(1, "A"), (1, "B"), (2, None), (3, "C"), (3, "C")], "inventory_id bigint, sku string"
    )
    active = spark.createDataFrame(
        [("A", D(2024, 1, 1)), (None, D(2024, 1, 1)), ("C", D(2024, 1, 2))],
        "variant_sku string, partition_date date",
    )
    assert rows(membership.active_sku_flag(orders, active, "2024-01-01"), "inventory_id") == [
        (1, 1), (2, 0), (3, 0),
    ]


def test_flag_conflicts(spark, rows):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1)], "k int, f int")
    assert [r[0] for r in rows(membership.conflicting_flags(df, "k", "f"))] == [1]
    with pytest.raises(ValueError, match="several values"):
        membership.require_no_conflicts(df, "k", "f")
    ok = df.filter("k = 2")
    assert membership.require_no_conflicts(ok, "k", "f") is ok


def test_missing_flag_is_zero(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    flags = spark.createDataFrame([(1, 1)], "k int, f int")
    assert rows(membership.with_flag(df, flags, "k", "f"), "k") == [(1, 1), (2, 0)]


def test_history_union_prefers_recurring_rows(spark, rows):
    history = spark.createDataFrame([("1", "old"), ("2", "old"), (None, "old")], "order_number string, src string")
    # Column order differs: the union is by name.
    recurring = spark.createDataFrame([("new", "2"), ("new", "2"), ("new", "3")], "src string, order_number string")
    union = membership.history_union(history, recurring)
    assert sorted(rows(union), key=str) == sorted(
        [("1", "old"), (None, "old"), ("2", "new"), ("2", "new"), ("3", "new")], key=str
    )
    assert "LeftAnti" in union._jdf.queryExecution().executedPlan().toString()
    late = membership.history_union(history, recurring, recurring_filter=F.col("order_number") == "3")
    assert ("2", "old") in rows(late) and ("2", "new") not in rows(late)
