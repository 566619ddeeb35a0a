"""Datasets behind the inventory dashboard and the replenishment alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import dates, numeric
from granary.operators import snapshots, timeseries

# Report windows, severity bands, alert thresholds and message wording.
SALES_WINDOWS = (30, 60, 90)
TREND_DAYS = 90
CHART_PADDING_DAYS = 14
CHART_LOW, CHART_HIGH = 0.95, 1.05
BANDS = ((60, "darkred"), (70, "red"))
UPPER_BAND = (100, "orange")
TOP_BAND = "green"
ALERT_BELOW_DAYS = 70
RESTOCK_TO_DAYS = 90
FINISHED_GOODS_LINE = (
    "• %s:\n  - Current stock: %s\n  - Estimated stockout date: %s\n  - Quantity to restock: %s\n"
)
RAW_MATERIAL_LINE = (
    "• %s:\n  - Current stock: %.2f %s\n"
    "  - Minimum Quantity Required to Meet Upcoming MO's as of %s: %s %s\n"
)


def _recent(df: DataFrame, day: Column, as_of: dt.date | str, days: int) -> DataFrame:
    return snapshots.trailing(df, day, as_of, days).filter(day <= dates.day_lit(as_of))


def item_days(orders: DataFrame, as_of: dt.date | str, days: int = TREND_DAYS) -> DataFrame:
    """Units per item, creation day and order day in the trailing window of either day.

    Stands for the lines where sales and run rates are wanted together: both plans hold the
    same aggregate, so Spark runs it, and the scan below it, once. Items and days are results of
    the aggregate, so that the filters of either plan stay above it.
    """
    created, ordered = F.to_date("created_date"), F.col("order_date")
    first, last = dates.day_lit(dates.to_day(as_of) - dt.timedelta(days=days)), dates.day_lit(as_of)
    sums = (
        orders.filter(created.between(first, last) | ordered.between(first, last))
        .groupBy(F.col("inventory_id").alias("_item"), "inventory_name", created.alias("_created"), ordered.alias("_ordered"))
        .agg(
            F.min("inventory_id").alias("inventory_id"),
            F.sum(F.coalesce("inventory_qty", F.lit(0))).alias("inventory_qty"),
            F.min(created).alias("created_date"),
            F.min(ordered).alias("order_date"),
        )
    )
    # Tests that keep all results of the aggregate in both plans; the sum is never null.
    for c in ("inventory_id", "created_date", "order_date"):
        sums = sums.filter(F.col(c).isNotNull() | F.col("inventory_qty").isNotNull())
    return sums.drop("_item", "_created", "_ordered")


def daily_item_sales(orders: DataFrame, as_of: dt.date | str, days: int = TREND_DAYS) -> DataFrame:
    """Units per item and creation day over the trailing window."""
    created = F.to_date("created_date")
    return (
        _recent(orders, created, as_of, days)
        .groupBy(created.alias("created_date"), "inventory_name", "inventory_id")
        .agg(F.sum("inventory_qty").alias("inventory_qty"))
    )


def trailing_sales(orders: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Units sold per item in the last 30, 60 and 90 days, as conditional sums of one pass."""
    created = F.to_date("created_date")
    today = dates.to_day(as_of)

    def sold(n: int) -> Column:
        in_window = created >= dates.day_lit(today - dt.timedelta(days=n))
        total = F.sum(F.when(in_window, F.col("inventory_qty")).otherwise(F.lit(0)))
        return total.cast("bigint").alias(f"actual_qty_sold_last_{n}_days")

    recent = _recent(orders, created, as_of, max(SALES_WINDOWS))
    return recent.groupBy("inventory_id").agg(*[sold(n) for n in SALES_WINDOWS])


def _rated(run_rates: DataFrame) -> DataFrame:
    """Newest run rates with a usable stock cover, rounded to whole days."""
    days = numeric.to_number(F.col("est_stock_days_on_hand"))
    return (
        snapshots.latest_if_partitioned(run_rates)
        .withColumn("est_stock_days_on_hand", days)
        .dropna(subset=["est_stock_days_on_hand"])
        .withColumn("est_stock_days_on_hand", numeric.half_even(F.col("est_stock_days_on_hand")))
    )


def inventory_status(run_rates: DataFrame, sales: DataFrame) -> DataFrame:
    """Status table: whole-number rates, cover and restock point with trailing sales."""
    sold = [f"actual_qty_sold_last_{n}_days" for n in SALES_WINDOWS]
    return (
        _rated(run_rates)
        .join(sales, "inventory_id", "left")
        .select(
            "inventory_id",
            "name",
            numeric.half_even(F.col("run_rate")).alias("run_rate"),
            "total_fulfillable_quantity",
            numeric.half_even(F.col("restock_point").cast("double")).alias("restock_point"),
            "est_stock_days_on_hand",
            "estimated_stockout_date",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in sold],
        )
    )


def severity_band(days: Column) -> Column:
    limit, colour = UPPER_BAND
    (critical, first), (low, second) = BANDS
    return (
        F.when(days < critical, first)
        .when(days < low, second)
        .when(days <= limit, colour)
        .otherwise(TOP_BAND)
    )


def product_cards(
    run_rates: DataFrame,
    min_days: int | None = None,
    max_days: int | None = None,
    hidden: tuple[str, ...] = (),
) -> DataFrame:
    """Name, cover and severity per item, least cover first."""
    days = F.col("est_stock_days_on_hand")
    cards = _rated(run_rates).select("inventory_id", "name", days)
    if min_days is not None:
        cards = cards.filter(days >= min_days)
    if max_days is not None:
        cards = cards.filter(days <= max_days)
    if hidden:
        cards = cards.filter(~F.col("name").isin(*hidden))
    return cards.withColumn("band", severity_band(days)).orderBy(days, "name", "inventory_id")


def metric_bounds(run_rates: DataFrame) -> DataFrame:
    days = "est_stock_days_on_hand"
    return _rated(run_rates).agg(F.min(days).alias("min_days"), F.max(days).alias("max_days"))


def product_options(run_rates: DataFrame) -> DataFrame:
    return _rated(run_rates).select("name").distinct().orderBy("name")


def lowest_stock(run_rates: DataFrame, n: int = 10) -> DataFrame:
    """The n items with the least cover."""
    order = ["est_stock_days_on_hand", "name", "inventory_id"]
    return _rated(run_rates).select(*order).orderBy(*order).limit(n)


def sales_with_metrics(daily_sales: DataFrame, run_rates: DataFrame) -> DataFrame:
    """Daily item sales with the item's current rate, stock-out date and restock point."""
    metrics = snapshots.latest_if_partitioned(run_rates).select(
        "inventory_id", "run_rate", "estimated_stockout_date", "restock_point", "name"
    )
    return daily_sales.join(metrics, "inventory_id", "left")


def product_levels(run_rates: DataFrame) -> DataFrame:
    """Horizontal guides per product name, taken from its lowest inventory id."""
    levels = {
        "daily_run_rate": numeric.half_even(F.col("run_rate")),
        "restock_point": F.col("restock_point"),
        "estimated_stockout_date": F.col("estimated_stockout_date"),
    }
    return (
        snapshots.latest_if_partitioned(run_rates)
        .groupBy("name")
        .agg(*[F.min_by(c, "inventory_id").alias(name) for name, c in levels.items()])
    )


def product_daily_series(daily_sales: DataFrame, run_rates: DataFrame) -> DataFrame:
    """Zero-filled daily units per product name between its own first and last day, with
    the product's run rate as a level. Items without a rated name have no product."""
    named = sales_with_metrics(daily_sales, run_rates).dropna(subset=["name"])
    daily = timeseries.daily_totals(named, ["name"], "created_date", "inventory_qty", "inventory_qty")
    dense = timeseries.zero_fill(daily, ["name"], "created_date", "inventory_qty")
    levels = product_levels(run_rates).select("name", "daily_run_rate")
    return dense.join(levels, "name", "left")


def stock_trend(
    stock_snapshots: DataFrame, run_rates: DataFrame, as_of: dt.date | str, days: int = TREND_DAYS
) -> DataFrame:
    """Stock per item and snapshot day over the trailing window, by date."""
    names = snapshots.latest_if_partitioned(run_rates).select(
        "inventory_id", "name", "restock_point"
    )
    recent = snapshots.trailing(stock_snapshots, "partition_date", as_of, days).select(
        F.col("id").alias("inventory_id"), "partition_date", "total_fulfillable_quantity"
    )
    return recent.join(names, "inventory_id", "left").orderBy("partition_date", "inventory_id")


def stock_trend_bounds(trend: DataFrame, run_rates: DataFrame) -> DataFrame:
    """Chart range per product name: padded dates and quantities, restock level and
    stock-out date."""
    quantity = F.col("total_fulfillable_quantity")
    spans = (
        trend.dropna(subset=["name"])
        .groupBy("name")
        .agg(
            F.min("partition_date").alias("x_min"),
            F.date_add(F.max("partition_date"), CHART_PADDING_DAYS).alias("x_max"),
            (F.min(quantity) * CHART_LOW).alias("y_min"),
            (F.max(quantity) * CHART_HIGH).alias("y_max"),
        )
    )
    levels = product_levels(run_rates).select("name", "restock_point", "estimated_stockout_date")
    return spans.join(levels, "name", "left")


def raw_material_alerts(status: DataFrame) -> DataFrame:
    """Materials that cannot cover the open manufacturing orders, with the message line."""
    short = snapshots.latest_if_partitioned(status).filter(
        F.col("needs_replenished").cast("boolean")
    )
    shortage = -numeric.half_even(F.col("inventory_remaining").cast("double"))
    line = F.format_string(
        RAW_MATERIAL_LINE,
        "name",
        "in_stock",
        "units_of_measure",
        F.col("in_stock_as_of").cast("string"),
        "shortage",
        "units_of_measure",
    )
    return (
        short.withColumn("shortage", shortage)
        .select(
            "name",
            "in_stock",
            "units_of_measure",
            "in_stock_as_of",
            "planned_qty_as_of",
            "shortage",
            line.alias("message"),
        )
    )


def finished_goods_alerts(
    run_rates: DataFrame,
    below_days: int = ALERT_BELOW_DAYS,
    restock_to_days: int = RESTOCK_TO_DAYS,
) -> DataFrame:
    """Items with little cover and something to restock.

    ``restock_amount`` uses whole days and decides whether a row is kept;
    ``quantity_to_restock`` is the amount named in the message.
    """
    gap = F.lit(float(restock_to_days)) - F.col("est_stock_days_on_hand")
    amount = numeric.whole_units(F.col("run_rate") * numeric.whole_units(gap))
    quantity = numeric.whole_units(F.col("run_rate") * gap)
    line = F.format_string(
        FINISHED_GOODS_LINE,
        "name",
        "total_fulfillable_quantity",
        F.col("estimated_stockout_date").cast("string"),
        "quantity_to_restock",
    )
    return (
        snapshots.latest_if_partitioned(run_rates)
        .filter(F.col("est_stock_days_on_hand") < below_days)
        .withColumns({"restock_amount": amount, "quantity_to_restock": quantity})
        .filter("restock_amount > 0")
        .select(
            "inventory_id",
            "name",
            "total_fulfillable_quantity",
            "estimated_stockout_date",
            "restock_amount",
            "quantity_to_restock",
            line.alias("message"),
        )
    )


def dashboard_datasets(
    orders: DataFrame, stock_snapshots: DataFrame, run_rates: DataFrame, as_of: dt.date | str
) -> dict[str, DataFrame]:
    """All dashboard frames for one day, lazily."""
    sales = daily_item_sales(orders, as_of)
    trend = stock_trend(stock_snapshots, run_rates, as_of)
    return {
        "inventory_status": inventory_status(run_rates, trailing_sales(orders, as_of)),
        "product_cards": product_cards(run_rates),
        "metric_bounds": metric_bounds(run_rates),
        "product_options": product_options(run_rates),
        "sales_vs_run_rate": sales_with_metrics(sales, run_rates),
        "product_daily_series": product_daily_series(sales, run_rates),
        "stock_trend": trend,
        "stock_trend_bounds": stock_trend_bounds(trend, run_rates),
    }
