"""Finished-goods and raw-material planning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import dates, moments, numeric
from granary.operators import membership, snapshots, timeseries
from granary.schemas import RAW_MATERIAL_RUN_RATE, RAW_MATERIAL_STATUS, RUN_RATE, RUN_RATE_MART

# Planning parameters behind the stored tables.
LOOKBACK_DAYS = 90
SMOOTHING = 0.5
MAX_STOCK_DAYS = 365
LEAD_TIME_DAYS = 70
SAFETY_STOCK_DAYS = 7
MATERIAL_LEAD_TIME_DAYS = 30
UNKNOWN_ITEM = "INVENTORY_ID_NOT_IN_INVENTORY_DETAILS"


def sales_window(
    orders: DataFrame, as_of: dt.date | str, lookback_days: int = LOOKBACK_DAYS, upper_bound: bool = True
) -> DataFrame:
    """Order lines dated [as_of - lookback, as_of]; ``upper_bound=False`` also keeps
    lines dated after ``as_of``."""
    recent = snapshots.trailing(orders, "order_date", as_of, lookback_days)
    return recent.filter(F.col("order_date") <= dates.day_lit(as_of)) if upper_bound else recent


def _stock_levels(snapshot: DataFrame, *extra: str) -> DataFrame:
    return snapshot.select(
        *extra, F.col("id").alias("inventory_id"), "name", "total_fulfillable_quantity"
    )


def _with_stock_metrics(rates: DataFrame, as_of: Column) -> DataFrame:
    """Stock cover of items whose rate and (possibly missing) stock stand on one row.

    A zero run rate means zero days on hand, by contract with the readers of the table.
    """
    stock = F.coalesce("total_fulfillable_quantity", F.lit(0)).cast("bigint")
    rate = F.col("run_rate")
    return (
        rates.withColumns(
            {
                "name": F.coalesce("name", F.lit(UNKNOWN_ITEM)),
                "total_fulfillable_quantity": stock,
                "est_stock_days_on_hand": numeric.ratio_or_zero(stock, rate, MAX_STOCK_DAYS),
                "restock_point": numeric.whole_units(
                    rate * LEAD_TIME_DAYS + rate * SAFETY_STOCK_DAYS
                ),
            }
        )
        .withColumn(
            "estimated_stockout_date",
            dates.plus_days(as_of, numeric.whole_units(F.col("est_stock_days_on_hand"))),
        )
    )


def run_rate(
    orders: DataFrame,
    stock_snapshots: DataFrame,
    as_of: dt.date | str,
    lookback_days: int = LOOKBACK_DAYS,
    upper_bound: bool = True,
) -> DataFrame:
    """Exponentially weighted daily sales per item sold in the window, its stock cover,
    stock-out date and restock point."""
    stock = snapshots.snapshot_before(stock_snapshots, as_of)
    return run_rate_with(orders, stock, as_of, lookback_days, upper_bound)


def run_rate_with(
    orders: DataFrame,
    stock: DataFrame,
    as_of: dt.date | str,
    lookback_days: int = LOOKBACK_DAYS,
    upper_bound: bool = True,
) -> DataFrame:
    """``run_rate`` with the stock of one day, already picked from its snapshots."""
    recent = sales_window(orders, as_of, lookback_days, upper_bound)
    rates = timeseries.ewm_last(
        recent, ["inventory_id"], "order_date", "inventory_qty", SMOOTHING
    )
    joined = rates.join(_stock_levels(stock), "inventory_id", "left")
    return _with_stock_metrics(joined, dates.day_lit(as_of)).select(*RUN_RATE.columns)


def run_rate_details(
    orders: DataFrame,
    stock_snapshots: DataFrame,
    active_skus: DataFrame,
    as_of: dt.date | str,
    lookback_days: int = LOOKBACK_DAYS,
    upper_bound: bool = True,
) -> DataFrame:
    """``run_rate`` plus the active flag and the shape of the demand series, which the
    stored table drops. Rate and power sums come from one aggregate."""
    recent = sales_window(orders, as_of, lookback_days, upper_bound)
    daily = timeseries.daily_totals(recent, ["inventory_id"], "order_date", "inventory_qty")
    first, last = timeseries.date_bounds(daily, "order_date")
    decayed = timeseries.decayed_quantity(F.col("qty_sold"), F.col("order_date"), last, SMOOTHING)
    days = F.col("days")
    rates = (
        daily.groupBy("inventory_id")
        .agg(F.sum(decayed).alias("decayed"), *moments.power_sums(F.col("qty_sold")))
        .withColumns({"first_day": first, "last_day": last})
        .withColumn("days", dates.days_between(F.col("first_day"), F.col("last_day")) + 1)
        .select(
            "inventory_id",
            timeseries.ewm_from_decayed(
                F.col("decayed"), F.col("first_day"), F.col("last_day"), SMOOTHING
            ).alias("run_rate"),
            moments.sample_skewness(days).alias("skew"),
            moments.sample_excess_kurtosis(days).alias("kurtosis"),
        )
    )
    flags = membership.active_sku_flag(recent, active_skus, as_of)
    stock = _stock_levels(snapshots.snapshot_before(stock_snapshots, as_of))
    joined = membership.with_flag(rates, flags, "inventory_id", "active_sku_fl").join(
        stock, "inventory_id", "left"
    )
    return _with_stock_metrics(joined, dates.day_lit(as_of)).select(
        *RUN_RATE.columns, F.col("active_sku_fl").alias("active_fl"), "skew", "kurtosis"
    )


def run_rate_range(
    orders: DataFrame,
    stock_snapshots: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """``run_rate`` of every day in [start, end] as one plan, keyed by ``partition_date``.

    Sales are summed per item and day once; each daily sum is then expanded to the run
    days whose window contains it.
    """
    start, end = dates.to_day(start), dates.to_day(end)
    recent = sales_window(orders, end, (end - start).days + lookback_days)
    day = F.col("order_date")
    run_days = F.sequence(
        F.greatest(day, dates.day_lit(start)),
        F.least(F.date_add(day, lookback_days), dates.day_lit(end)),
    )
    as_of = F.explode(run_days).alias("partition_date")
    # Bounds of each run day's window: one row per run day, so safe to broadcast.
    daily = timeseries.daily_totals(recent, ["inventory_id"], "order_date", "inventory_qty")
    bounds = (
        daily.groupBy("order_date")
        .agg(F.count("*").alias("items"))
        .select("order_date", as_of)
        .groupBy("partition_date")
        .agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    )
    decayed = timeseries.decayed_quantity(F.col("qty_sold"), day, F.col("last_day"), SMOOTHING)
    keys = ["partition_date", "inventory_id", "first_day", "last_day"]
    rates = (
        daily.select("*", as_of)
        .join(F.broadcast(bounds), "partition_date")
        .groupBy(*keys)
        .agg(F.sum(decayed).alias("decayed"))
        .select(
            "partition_date",
            "inventory_id",
            timeseries.ewm_from_decayed(
                F.col("decayed"), F.col("first_day"), F.col("last_day"), SMOOTHING
            ).alias("run_rate"),
        )
    )
    # One row per run day again; its partition dates prune the snapshot table.
    calendar = snapshots.snapshot_calendar(stock_snapshots, start, end)
    stock = _stock_levels(
        stock_snapshots.join(
            F.broadcast(calendar.withColumnRenamed("snapshot_date", "partition_date")),
            "partition_date",
        ).drop("partition_date"),
        "as_of",
    ).withColumnRenamed("as_of", "partition_date")
    joined = rates.join(stock, ["partition_date", "inventory_id"], "left")
    return _with_stock_metrics(joined, F.col("partition_date")).select(
        *RUN_RATE.columns, "partition_date"
    )


def _newest(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The newest partition, or with ``by`` (run days, see ``snapshots.each_day``) all rows."""
    return df if by else snapshots.latest_if_partitioned(df)


def run_rate_mart(run_rates: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Newest run rates under the report's column names and types."""
    newest = _newest(run_rates, by)
    renamed = newest.withColumn("est_daily_run_rate", F.col("run_rate"))
    return renamed.select(
        *[F.col(f.name).cast(f.type).alias(f.name) for f in RUN_RATE_MART.fields], *by
    )


def ingredient_demand(run_rates: DataFrame, formulas: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Daily demand per raw material: run rate times quantity required, over all products."""
    rates = _newest(run_rates, by).select(
        F.col("inventory_id").cast("double").alias("product_variant_code"), "run_rate", *by
    )
    recipe = _newest(formulas, by).select(
        "product_variant_code",
        *by,
        F.col("ingredient_variant_code_sku_required").alias("katana_ingredient_sku"),
        F.col("ingredient_variant_name").alias("katana_ingredient_name"),
        F.col("unit_of_measure").alias("katana_unit_of_measure"),
        "quantity_required",
    )
    return (
        rates.join(recipe, ["product_variant_code", *by])
        .groupBy(*by, "katana_ingredient_sku", "katana_ingredient_name", "katana_unit_of_measure")
        .agg(F.sum(F.col("run_rate") * F.col("quantity_required")).alias("daily_run_rate"))
    )


def raw_material_run_rate(
    run_rates: DataFrame, formulas: DataFrame, material_stock: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Demand, cover and reorder point per raw material that has a stock row.

    A safety stock of 0 means "use the default lead time"; an unknown one leaves the
    reorder point unknown.
    """
    demand = ingredient_demand(run_rates, formulas, by)
    stock = _newest(material_stock, by).select(
        *by,
        F.col("variant_code_sku").alias("katana_ingredient_sku"),
        F.col("in_stock").alias("inventory_on_hand"),
        F.col("partition_date").alias("inventory_as_of"),
        "safety_stock",
    )
    lead_time_demand = F.col("daily_run_rate") * MATERIAL_LEAD_TIME_DAYS
    buffer = F.when(F.col("safety_stock") == 0, lead_time_demand).otherwise(F.col("safety_stock"))
    return (
        demand.join(stock, ["katana_ingredient_sku", *by])
        .withColumns(
            {
                "days_on_hand": numeric.ratio(F.col("inventory_on_hand"), F.col("daily_run_rate")),
                "reorder_point": lead_time_demand + buffer,
            }
        )
        .select(*RAW_MATERIAL_RUN_RATE.columns, *by)
    )


def planned_material(
    open_orders: DataFrame, per_material: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """Ingredient quantity planned in the newest open manufacturing orders.

    Grouped by material and product unit of measure, so a material used under two units
    has two rows; ``per_material=True`` adds them up. Rows with a null key are dropped.
    """
    keys = ["ingredient_variant_code_sku", "ingredient_variant", "unit_of_measure"]
    newest = _newest(open_orders, by).withColumnRenamed("partition_date", "planned_qty_as_of")
    per = [*by, "planned_qty_as_of", *(keys[:1] if per_material else keys)]
    quantity = F.coalesce("planned_quantity_of_ingredient", F.lit(0.0))
    return (
        newest.dropna(subset=per)
        .groupBy(*per)
        .agg(F.sum(quantity).alias("planned_qty"))
        .withColumnRenamed("ingredient_variant_code_sku", "variant_code_sku")
        .select(*by, "planned_qty_as_of", "variant_code_sku", "planned_qty")
    )


def raw_material_status(
    material_stock: DataFrame, open_orders: DataFrame, per_material: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """Stock against planned use for every material with planned use."""
    in_stock = F.coalesce("in_stock", F.lit(0.0))
    stock = _newest(material_stock, by).select(
        *by,
        "variant_code_sku",
        "name",
        "units_of_measure",
        in_stock.alias("in_stock"),
        F.col("partition_date").alias("in_stock_as_of"),
    )
    planned = planned_material(open_orders, per_material, by).filter("planned_qty > 0")
    # Only positive planned quantities are kept, so unmatched stock rows never survive.
    covered = stock.join(planned, ["variant_code_sku", *by])
    remaining = F.col("in_stock") - F.col("planned_qty")
    return covered.withColumns(
        {
            "inventory_remaining": remaining,
            "in_stock_percentage": numeric.ratio(F.col("in_stock"), F.col("planned_qty")),
            "needs_replenished": remaining < 0,
        }
    ).select(*RAW_MATERIAL_STATUS.columns, *by)
