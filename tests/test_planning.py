import datetime as dt

import pandas as pd
import pytest

from granary.plans import planning, reporting

AS_OF = dt.date(2024, 4, 1)
D = dt.timedelta


def orders(spark, *cells):
    """(inventory_id, days before AS_OF, quantity)"""
    return spark.createDataFrame(
        [(i, AS_OF - D(days=back), q, f"S{i}") for i, back, q in cells],
        "inventory_id bigint, order_date date, inventory_qty bigint, sku string",
    )


def stock(spark, *cells):
    """(id, name, quantity, days before AS_OF)"""
    return spark.createDataFrame(
        [(i, n, q, AS_OF - D(days=back)) for i, n, q, back in cells],
        "id bigint, name string, total_fulfillable_quantity bigint, partition_date date",
    )


def by_item(df):
    return {r.inventory_id: r for r in df.collect()}


def test_run_rate_by_hand(spark):
    got = by_item(planning.run_rate(
        orders(spark, (1, 0, 4), (1, 1, 2), (2, 2, 8), (3, 0, 0)),
        stock(spark, (1, "one", 30, 1), (1, "stale", 99, 5), (1, "future", 77, 0)),
        AS_OF,
    ))
    # Three calendar days: weights 1, 1/2, 1/4.
    assert got[1].run_rate == pytest.approx((4 + 2 / 2) / 1.75)
    assert got[2].run_rate == pytest.approx((8 / 4) / 1.75)
    assert (got[1].name, got[1].total_fulfillable_quantity) == ("one", 30)
    assert got[1].est_stock_days_on_hand == pytest.approx(30 / (5 / 1.75))
    assert got[1].estimated_stockout_date == AS_OF + D(days=10)
    assert got[1].restock_point == 220
    # Not in the snapshot: no stock, placeholder name.
    assert (got[2].name, got[2].total_fulfillable_quantity) == ("INVENTORY_ID_NOT_IN_INVENTORY_DETAILS", 0)
    assert got[2].est_stock_days_on_hand == 0


def test_zero_rate_means_zero_days_and_cover_is_capped(spark):
    got = by_item(planning.run_rate(
        orders(spark, (1, 0, 0), (2, 0, 1)), stock(spark, (1, "a", 50, 1), (2, "b", 5000, 1)), AS_OF
    ))
    assert (got[1].run_rate, got[1].est_stock_days_on_hand, got[1].restock_point) == (0, 0, 0)
    assert got[1].estimated_stockout_date == AS_OF
    assert got[2].est_stock_days_on_hand == 365


def test_window_bounds(spark):
    lines = orders(spark, (1, 90, 1), (2, 91, 1), (3, -1, 1))
    empty = stock(spark)
    assert set(by_item(planning.run_rate(lines, empty, AS_OF))) == {1}
    assert set(by_item(planning.run_rate(lines, empty, AS_OF, upper_bound=False))) == {1, 3}
    assert planning.run_rate(orders(spark), empty, AS_OF).count() == 0


def test_details_agree_with_run_rate_and_pandas(spark):
    cells = [(1, 0, 4), (1, 9, 2), (1, 9, 3), (2, 5, 8)]
    lines, shelf = orders(spark, *cells), stock(spark, (1, "one", 30, 1))
    active = spark.createDataFrame([("S1", AS_OF), ("S2", AS_OF - D(days=1))], "variant_sku string, partition_date date")
    details = by_item(planning.run_rate_details(lines, shelf, active, AS_OF))
    plain = by_item(planning.run_rate(lines, shelf, AS_OF))
    for item, row in plain.items():
        assert tuple(row) == tuple(details[item])[: len(row)]
    series = pd.Series([5, 0, 0, 0, 0, 0, 0, 0, 0, 4], dtype=float)
    assert details[1].skew == pytest.approx(series.skew())
    assert details[1].kurtosis == pytest.approx(series.kurt())
    assert (details[1].active_fl, details[2].active_fl) == (1, 0)


def test_range_equals_single_days(spark):
    lines = orders(spark, (1, 0, 4), (1, 3, 2), (2, 2, 8), (2, 95, 1), (3, 91, 5), (4, -3, 9))
    shelf = stock(spark, (1, "a", 9, 4), (1, "a", 7, 2), (2, "b", 5, 2), (1, "a", 1, 0))
    start = AS_OF - D(days=4)
    ranged = planning.run_rate_range(lines, shelf, start, AS_OF).collect()
    for back in range(5):
        day = AS_OF - D(days=back)
        single = sorted(tuple(r) for r in planning.run_rate(lines, shelf, day).collect())
        many = sorted(tuple(r)[:-1] for r in ranged if r.partition_date == day)
        assert [r[2:] for r in many] == [r[2:] for r in single], day
        assert [r[1] for r in many] == pytest.approx([r[1] for r in single]), day


def test_mart_takes_the_newest_day(spark):
    ranged = planning.run_rate_range(orders(spark, (1, 1, 4)), stock(spark, (1, "a", 9, 9)), AS_OF - D(days=1), AS_OF)
    mart = planning.run_rate_mart(ranged)
    assert mart.columns[3] == "est_daily_run_rate" and mart.count() == 1
    assert mart.first().estimated_stockout_date >= AS_OF


FORMULA = (
    "product_variant_code double, ingredient_variant_code_sku_required string,"
    "ingredient_variant_name string, quantity_required double, unit_of_measure string, partition_date date"
)
STOCK = (
    "variant_code_sku string, name string, units_of_measure string, in_stock double,"
    "safety_stock double, partition_date date"
)


def test_raw_material_run_rate(spark):
    rates = spark.createDataFrame([(1, 2.0), (2, 3.0), (9, 1.0)], "inventory_id bigint, run_rate double")
    old, new = AS_OF - D(days=7), AS_OF
    formulas = spark.createDataFrame(
        [(1.0, "A", "a", 0.5, "kg", new), (2.0, "A", "a", 1.0, "kg", new), (2.0, "B", "b", 2.0, "kg", new),
         (1.0, "C", "c", 1.0, "kg", new), (1.0, "D", "d", 0.0, "kg", new), (1.0, "A", "a", 99.0, "kg", old),
         (1.0, None, "n", 1.0, "kg", new), (1.0, "X", "x", 1.0, "kg", new)], FORMULA)
    shelf = spark.createDataFrame(
        [("A", "A", "kg", 8.0, 0.0, new), ("B", "B", "kg", -6.0, 5.0, new), ("C", "C", "kg", 4.0, None, new),
         ("D", "D", "kg", 4.0, 1.0, new), ("A", "A", "kg", 1.0, 0.0, old), (None, "?", "kg", 1.0, 0.0, new)], STOCK)
    got = {r.katana_ingredient_sku: r for r in planning.raw_material_run_rate(rates, formulas, shelf).collect()}
    assert set(got) == {"A", "B", "C", "D"}
    assert (got["A"].daily_run_rate, got["A"].days_on_hand, got["A"].reorder_point) == (4.0, 2.0, 240.0)
    assert (got["B"].daily_run_rate, got["B"].days_on_hand, got["B"].reorder_point) == (6.0, -1.0, 185.0)
    assert got["C"].reorder_point is None
    assert (got["D"].daily_run_rate, got["D"].days_on_hand, got["D"].reorder_point) == (0.0, None, 1.0)


MO = (
    "ingredient_variant_code_sku string, ingredient_variant string, unit_of_measure string,"
    "planned_quantity_of_ingredient double, partition_date date"
)


def test_raw_material_status(spark):
    old, new = AS_OF - D(days=7), AS_OF
    shelf = spark.createDataFrame(
        [("A", "Flour", "kg", 5.0, 0.0, new), ("B", "Salt", "kg", None, 0.0, new), ("C", "Oil", "l", 5.0, 0.0, new),
         ("Z", "Unused", "kg", 5.0, 0.0, new)], STOCK)
    mos = spark.createDataFrame(
        [("A", "Flour", "pcs", 2.0, new), ("A", "Flour", "case", 6.0, new), ("A", "Flour", "case", 1.0, new),
         ("B", "Salt", "pcs", 1.0, new), ("C", "Oil", None, 3.0, new), ("C", "Oil", "pcs", None, new),
         ("Z", "Unused", "pcs", 9.0, old)], MO)
    rows = sorted(tuple(r) for r in planning.raw_material_status(shelf, mos).collect())
    assert rows == [
        ("Flour", "kg", 5.0, new, 2.0, new, 3.0, 2.5, False),
        ("Flour", "kg", 5.0, new, 7.0, new, -2.0, 5 / 7, True),
        ("Salt", "kg", 0.0, new, 1.0, new, -1.0, 0.0, True),
    ]
    whole = {r.name: r for r in planning.raw_material_status(shelf, mos, per_material=True).collect()}
    assert whole["Flour"].planned_qty == 9.0 and whole["Oil"].planned_qty == 3.0

    alerts = {(r.name, r.shortage): r for r in reporting.raw_material_alerts(planning.raw_material_status(shelf, mos)).collect()}
    assert set(alerts) == {("Flour", 2), ("Salt", 1)}
    assert alerts["Flour", 2].message.splitlines()[1] == "  - Current stock: 5.00 kg"
    assert "as of 2024-04-01: 2 kg" in alerts["Flour", 2].message


def rated(spark, *cells):
    """(id, name, rate, quantity, days, restock point)"""
    return spark.createDataFrame(
        [(i, r, n, q, d, AS_OF + D(days=int(d or 0)), p) for i, n, r, q, d, p in cells],
        "inventory_id bigint, run_rate double, name string, total_fulfillable_quantity bigint,"
        "est_stock_days_on_hand double, estimated_stockout_date date, restock_point bigint",
    )


def test_severity_bands(spark):
    days = [59, 60, 69, 70, 100, 101]
    cards = reporting.product_cards(rated(spark, *[(d, f"p{d}", 1.0, 1, float(d), 1) for d in days]))
    assert [(r.est_stock_days_on_hand, r.band) for r in cards.collect()] == list(
        zip(days, ["darkred", "red", "red", "orange", "orange", "green"])
    )


def test_cards_filters_and_rounding(spark):
    rates = rated(spark, (1, "a", 1.0, 1, 0.5, 1), (2, "b", 1.0, 1, 1.5, 1), (3, "c", 1.0, 1, 2.5, 1),
                  (4, "d", 1.0, 1, None, 1))
    assert [r.est_stock_days_on_hand for r in reporting.product_cards(rates).collect()] == [0, 2, 2]
    assert [r.name for r in reporting.product_cards(rates, 1, 2, hidden=("c",)).collect()] == ["b"]
    assert tuple(reporting.metric_bounds(rates).first()) == (0, 2)
    assert [r.name for r in reporting.product_options(rates).collect()] == ["a", "b", "c"]
    assert [r.name for r in reporting.lowest_stock(rates, 2).collect()] == ["a", "b"]


def test_finished_goods_alerts(spark):
    rates = rated(
        spark,
        (1, "low", 2.5, 10, 4.0, 1),
        (2, "edge", 2.5, 175, 70.0, 1),
        (3, "idle", 0.0, 10, 0.0, 1),
        (4, "part", 1.0, 10, 10.6, 1),
    )
    got = {r.name: r for r in reporting.finished_goods_alerts(rates).collect()}
    assert set(got) == {"low", "part"}
    assert (got["low"].restock_amount, got["low"].quantity_to_restock) == (215, 215)
    # Whole days for the threshold, exact days in the message.
    assert (got["part"].restock_amount, got["part"].quantity_to_restock) == (79, 79)
    assert got["low"].message == (
        "• low:\n  - Current stock: 10\n  - Estimated stockout date: 2024-04-05\n  - Quantity to restock: 215\n"
    )


def sales(spark, *cells):
    return spark.createDataFrame(
        [(dt.datetime.combine(AS_OF - D(days=b), dt.time(23)), f"n{i}", i, q) for i, b, q in cells],
        "created_date timestamp_ntz, inventory_name string, inventory_id bigint, inventory_qty bigint",
    )


def test_trailing_sales_and_status(spark):
    lines = sales(spark, (1, 0, 1), (1, 30, 2), (1, 31, 4), (1, 60, 8), (1, 61, 16), (1, 90, 32), (1, 91, 64), (1, -1, 128))
    trailing = reporting.trailing_sales(lines, AS_OF)
    assert tuple(trailing.first()) == (1, 3, 15, 63)
    rates = rated(spark, (1, "a", 2.5, 7, 3.5, 4), (2, "b", 3.5, 7, 2.5, 4))
    got = by_item(reporting.inventory_status(rates, trailing))
    assert tuple(got[1])[2:6] == (2, 7, 4, 4) and tuple(got[1])[-3:] == (3, 15, 63)
    assert tuple(got[2])[2:6] == (4, 7, 4, 2) and tuple(got[2])[-3:] == (0, 0, 0)


def test_product_series_sums_items_of_one_name(spark, rows):
    rates = rated(spark, (1, "p", 2.0, 1, 1.0, 10), (2, "p", 5.0, 1, 1.0, 20))
    lines = sales(spark, (1, 5, 1), (2, 5, 2), (2, 3, 4), (3, 1, 9))
    series = reporting.product_daily_series(reporting.daily_item_sales(lines, AS_OF), rates)
    assert [(r[0], (AS_OF - r[1]).days, r[2], r[3]) for r in rows(series, "created_date")] == [
        ("p", 5, 3, 2), ("p", 4, 0, 2), ("p", 3, 4, 2),
    ]
    joined = reporting.sales_with_metrics(reporting.daily_item_sales(lines, AS_OF), rates)
    assert joined.filter("inventory_id = 3").first().name is None


def test_stock_trend_and_bounds(spark):
    shelf = stock(spark, (1, "x", 100, 90), (1, "x", 60, 3), (1, "x", 10, 91), (9, "y", 5, 2))
    rates = rated(spark, (1, "p", 2.0, 1, 1.0, 10))
    trend = reporting.stock_trend(shelf, rates, AS_OF)
    assert [(r.inventory_id, r.total_fulfillable_quantity, r.name) for r in trend.collect()] == [
        (1, 100, "p"), (1, 60, "p"), (9, 5, None),
    ]
    (row,) = reporting.stock_trend_bounds(trend, rates).collect()
    assert (row.x_min, row.x_max) == (AS_OF - D(days=90), AS_OF + D(days=11))
    assert (row.y_min, row.y_max, row.restock_point) == (pytest.approx(57), pytest.approx(105), 10)
    everything = reporting.dashboard_datasets(sales(spark, (1, 0, 1)), shelf, rates, AS_OF)
    assert all(df.count() >= 1 for df in everything.values())
