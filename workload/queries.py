"""Every product and operator as a query over the test tables.

Each entry takes the session and a data directory and returns a lazy frame. Results are
made comparable across engines at the edge only: doubles are rounded to six places and
wall-clock timestamps are shown as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import dates, json_paths, numeric, text
from granary.operators import dimension, membership, quality, snapshots, timeseries
from granary.plans import customers, jobs, planning, reporting
from granary.schemas import STORE_LINE_ITEMS, STORE_ORDERS
from granary.session import configure
from granary.sources import payloads, scans, sinks
from workload.views import AS_OF, COHORT_START, RANGE_START, Tables

RETENTION_START, RETENTION_END = dt.date(2000, 3, 20), dt.date(2000, 4, 20)
CHANGE_TIME = dt.datetime(2001, 7, 1, 12, 0, 0)
EVENTS_YESTERDAY = dt.date(2024, 2, 3)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = dates.wall_clock_text(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Tables(configure(spark), sf_dir)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    _REGISTRY[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- planning ------------------------------------------------------------------------


def _sales(t: Tables, *extra: str) -> DataFrame:
    return t.order_details("inventory_id", "inventory_qty", "order_date", *extra)


def _rates(t: Tables) -> DataFrame:
    return planning.run_rate(_sales(t), t.stocked_snapshots(), AS_OF)


@query
def run_rate(t: Tables) -> DataFrame:
    return _rates(t)


@query
def run_rate_details(t: Tables) -> DataFrame:
    return planning.run_rate_details(
        _sales(t, "sku"), t.stocked_snapshots(), t.active_skus(), AS_OF
    )


@query
def run_rate_range(t: Tables) -> DataFrame:
    return planning.run_rate_range(_sales(t), t.stocked_snapshots(), RANGE_START, AS_OF)


@query
def run_rate_mart(t: Tables) -> DataFrame:
    rates = planning.run_rate_range(
        _sales(t), t.stocked_snapshots(), AS_OF - dt.timedelta(days=1), AS_OF
    )
    return planning.run_rate_mart(rates)


@query
def active_sku_flag(t: Tables) -> DataFrame:
    recent = planning.sales_window(t.order_details("inventory_id", "sku", "order_date"), AS_OF)
    return membership.active_sku_flag(recent, t.active_skus(), AS_OF)


@query
def flag_conflicts(t: Tables) -> DataFrame:
    """Customers flagged by the state of their orders carry conflicting flags."""
    orders = t.table("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished_fl"),
    )
    return membership.conflicting_flags(orders, "customer_id", "finished_fl")


def _daily_sales(t: Tables) -> DataFrame:
    recent = planning.sales_window(_sales(t), AS_OF)
    return timeseries.daily_totals(recent, ["inventory_id"], "order_date", "inventory_qty")


@query
def daily_qty_sold(t: Tables) -> DataFrame:
    recent = planning.sales_window(_sales(t, "sku"), AS_OF)
    flags = membership.active_sku_flag(recent, t.active_skus(), AS_OF)
    daily = timeseries.daily_totals(recent, ["inventory_id"], "order_date", "inventory_qty")
    # The flag depends on the item alone, so it joins the daily sums, not the lines.
    return membership.with_flag(daily, flags, "inventory_id", "active_sku_fl")


def _dense_sales(t: Tables) -> DataFrame:
    daily = _daily_sales(t)
    bounds = timeseries.date_bounds(daily, "order_date")
    return timeseries.zero_fill(daily, ["inventory_id"], "order_date", "qty_sold", bounds)


@query
def zero_filled_daily_sales(t: Tables) -> DataFrame:
    return _dense_sales(t)


@query
def ewm_series(t: Tables) -> DataFrame:
    start = AS_OF - dt.timedelta(days=planning.LOOKBACK_DAYS)
    return timeseries.ewm_series(
        _dense_sales(t), ["inventory_id"], "order_date", "qty_sold", start
    )


@query
def demand_shape(t: Tables) -> DataFrame:
    return timeseries.demand_shape(_daily_sales(t), ["inventory_id"], "order_date", "qty_sold")


@query
def raw_material_run_rate(t: Tables) -> DataFrame:
    return planning.raw_material_run_rate(_rates(t), t.formulas(), t.material_stock())


@query
def raw_material_status(t: Tables) -> DataFrame:
    return planning.raw_material_status(t.material_stock(), t.open_mos())


@query
def raw_material_status_per_material(t: Tables) -> DataFrame:
    return planning.raw_material_status(t.material_stock(), t.open_mos(), per_material=True)


def _report_range(name: str, **tables: DataFrame) -> DataFrame:
    """All days of a report's range, as its back-fill makes them."""
    return jobs.REPORTS[name].build_range(tables, RANGE_START, AS_OF)


@query
def run_rate_mart_range(t: Tables) -> DataFrame:
    rates = planning.run_rate_range(_sales(t), t.stocked_snapshots(), RANGE_START, AS_OF)
    return _report_range("inventory_run_rate_mart", inventory_run_rate=rates)


@query
def raw_material_run_rate_range(t: Tables) -> DataFrame:
    rates = planning.run_rate_range(_sales(t), t.stocked_snapshots(), RANGE_START, AS_OF)
    return _report_range(
        "raw_material_run_rate", inventory_run_rate=rates, formulas=t.formulas(), material_inventory=t.material_stock()
    )


@query
def raw_material_status_range(t: Tables) -> DataFrame:
    return _report_range(
        "raw_material_status", material_inventory=t.material_stock(), open_manufacturing_orders=t.open_mos()
    )


@query
def current_inventory_range(t: Tables) -> DataFrame:
    return _report_range("current_inventory", inventory_details=t.inventory_snapshots())


# -- snapshots and dates ---------------------------------------------------------------


@query
def asof_snapshot(t: Tables) -> DataFrame:
    return snapshots.snapshot_before(t.inventory_snapshots(), AS_OF)


@query
def latest_snapshot(t: Tables) -> DataFrame:
    return snapshots.latest_partition(t.inventory_snapshots())


@query
def inventory_projection(t: Tables) -> DataFrame:
    return payloads.project_inventory(payloads.parse_documents(t.inventory_docs(), "inventory"))


@query
def missing_dates(t: Tables) -> DataFrame:
    return snapshots.missing_dates(t.daily_events(), "event_date", EVENTS_YESTERDAY)


@query
def missing_dates_by_source(t: Tables) -> DataFrame:
    orders = t.table("orders").select(
        F.col("o_orderpriority").alias("order_type"), F.to_date("o_orderdate").alias("missing_date")
    )
    return snapshots.missing_dates_by(orders, "order_type", "missing_date", AS_OF, 90)


@query
def rows_per_date(t: Tables) -> DataFrame:
    return scans.rows_per_date(t.order_details("order_date"), "order_date")


@query
def date_range_slice(t: Tables) -> DataFrame:
    lines = t.order_details("shipbob_order_id", "inventory_id", "inventory_qty", "order_date")
    return scans.date_slice(lines, "order_date", "2001-06-01", "2001-06-30")


@query
def partition_split_counts(t: Tables) -> DataFrame:
    lines = sinks.split_by_day(
        t.order_details("purchase_date", "inventory_qty"), "purchase_date", "order_date"
    )
    parts = sinks.with_day_parts(lines, "order_date")
    return parts.groupBy("year", "month", "day").agg(
        F.count("*").alias("row_count"), F.sum("inventory_qty").alias("inventory_qty")
    )


# -- customers ---------------------------------------------------------------------------


@query
def history_union(t: Tables) -> DataFrame:
    return customers.order_history(t.historic_orders(), t.recurring_orders(), COHORT_START)


def _history(t: Tables) -> DataFrame:
    columns = ("order_number", "customer_email", "purchase_date")
    return customers.order_day_history(
        t.historic_orders(*columns), t.recurring_orders(*columns), COHORT_START
    )


@query
def first_orders(t: Tables) -> DataFrame:
    return customers.first_orders(_history(t), COHORT_START)


@query
def retention_flags(t: Tables) -> DataFrame:
    return customers.retention_flags(_history(t), COHORT_START)


@query
def retention_by_cohort(t: Tables) -> DataFrame:
    flags = customers.retention_flags(_history(t), COHORT_START)
    return customers.retention_by_cohort(flags)


def _order_lines(t: Tables) -> tuple[DataFrame, DataFrame]:
    columns = ("order_number", "customer_email", "purchase_date")
    return t.historic_orders(*columns), t.recurring_orders(*columns)


@query
def retention_by_cohort_on(t: Tables) -> DataFrame:
    """Retention as it was on a day when half of the history was not filed as recurring."""
    return customers.retention_on(*_order_lines(t), RETENTION_START, COHORT_START)


@query
def retention_by_cohort_range(t: Tables) -> DataFrame:
    return customers.retention_range(*_order_lines(t), RETENTION_START, RETENTION_END, COHORT_START)


@query
def retention_state_flags(t: Tables) -> DataFrame:
    """Flags on the last day of the range, from the state of its first day and the orders since."""
    history, recurring = _order_lines(t)
    begun = customers.begin_state(history, recurring, RETENTION_START, COHORT_START)
    since = (F.col("order_date") > F.lit(RETENTION_START)) & (F.col("order_date") <= F.lit(RETENTION_END))
    state, left = customers.advance_state(*begun, recurring.filter(since), COHORT_START)
    return customers.state_flags(state, left, RETENTION_END, COHORT_START)


_CHANNEL_COLUMNS = ("channel_id", "channel_name", "order_number", "order_date")


@query
def daily_order_cnt_by_channel(t: Tables) -> DataFrame:
    return customers.daily_order_counts(t.order_details(*_CHANNEL_COLUMNS), AS_OF)


@query
def daily_order_cnt_by_channel_range(t: Tables) -> DataFrame:
    return customers.daily_order_counts(
        t.order_details(*_CHANNEL_COLUMNS), "1995-01-01", "2001-12-31"
    )


@query
def obfuscated_line_items(t: Tables) -> DataFrame:
    return customers.obfuscated_line_items(t.historic_orders(), t.recurring_orders(), AS_OF)


# -- reporting ----------------------------------------------------------------------------


def _item_sales(t: Tables) -> DataFrame:
    lines = t.order_details("created_date", "inventory_name", "inventory_id", "inventory_qty")
    return reporting.daily_item_sales(lines, AS_OF)


def _item_days(t: Tables) -> DataFrame:
    lines = t.order_details("created_date", "order_date", "inventory_name", "inventory_id", "inventory_qty")
    return reporting.item_days(lines, AS_OF)


def _sales_and_rates(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Item sales and run rates from one pass over the lines."""
    days = _item_days(t)
    return reporting.daily_item_sales(days, AS_OF), planning.run_rate(days, t.stocked_snapshots(), AS_OF)


def _trailing(t: Tables) -> DataFrame:
    lines = t.order_details("created_date", "inventory_id", "inventory_qty")
    return reporting.trailing_sales(lines, AS_OF)


@query
def daily_item_sales(t: Tables) -> DataFrame:
    return _item_sales(t)


@query
def trailing_sales_30_60_90(t: Tables) -> DataFrame:
    return _trailing(t)


@query
def inventory_status(t: Tables) -> DataFrame:
    days = _item_days(t)
    rates = planning.run_rate(days, t.stocked_snapshots(), AS_OF)
    return reporting.inventory_status(rates, reporting.trailing_sales(days, AS_OF))


@query
def product_cards(t: Tables) -> DataFrame:
    return reporting.product_cards(_rates(t), 10, 365, hidden=("red widget", "small ring"))


@query
def lowest_stock_top10(t: Tables) -> DataFrame:
    return reporting.lowest_stock(_rates(t))


@query
def metric_bounds(t: Tables) -> DataFrame:
    return reporting.metric_bounds(_rates(t))


@query
def product_options(t: Tables) -> DataFrame:
    return reporting.product_options(_rates(t))


@query
def sales_vs_run_rate(t: Tables) -> DataFrame:
    return reporting.sales_with_metrics(*_sales_and_rates(t))


@query
def product_daily_series(t: Tables) -> DataFrame:
    return reporting.product_daily_series(*_sales_and_rates(t))


@query
def stock_trend(t: Tables) -> DataFrame:
    return reporting.stock_trend(t.inventory_snapshots(), _rates(t), AS_OF)


@query
def stock_trend_bounds(t: Tables) -> DataFrame:
    rates = _rates(t)
    trend = reporting.stock_trend(t.inventory_snapshots(), rates, AS_OF)
    return reporting.stock_trend_bounds(trend, rates)


@query
def alert_raw_materials(t: Tables) -> DataFrame:
    return reporting.raw_material_alerts(
        planning.raw_material_status(t.material_stock(), t.open_mos())
    )


@query
def alert_finished_goods(t: Tables) -> DataFrame:
    return reporting.finished_goods_alerts(_rates(t))


# -- validation and cleansing ----------------------------------------------------------------


@query
def validate_split(t: Tables) -> DataFrame:
    checked = quality.check(t.raw_store_orders(), STORE_ORDERS)
    return checked.select(
        F.col(f"{quality.RAW}.order_id").alias("order_key"),
        F.when(F.size(quality.ERRORS) == 0, "valid").otherwise("invalid").alias("outcome"),
        F.array_join(quality.ERRORS, "; ").alias("error"),
        "email",
        "created_at",
        "shipping_address",
        "total_line_items_price",
        "total_discounts",
        "total_shipping_fee",
        "order_date",
    )


@query
def validation_summary(t: Tables) -> DataFrame:
    return quality.summary(t.raw_store_orders(), STORE_ORDERS)


@query
def cleanse_orders(t: Tables) -> DataFrame:
    cleansed = quality.cleanse(t.raw_store_lines(), STORE_LINE_ITEMS)
    return cleansed.withColumn("created_at", dates.wall_clock_text(F.col("created_at")))


@query
def nan_to_null(t: Tables) -> DataFrame:
    quantity = F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", quantity.alias("quantity"), F.col("l_tax").alias("tax")
    )
    return quality.nan_to_null(lines)


@query
def parse_dates(t: Tables) -> DataFrame:
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    status = F.col("o_orderstatus")
    written = F.when(status == "P", F.lit("")).when(status == "F", F.translate(day, "-", "/"))
    return t.table("orders").select(
        "o_orderkey", dates.parse_day(written.otherwise(day)).alias("parsed_date")
    )


@query
def sanitize_delimiters(t: Tables) -> DataFrame:
    titles = t.raw_store_lines().select("order_id", "line_number", "title", "sku")
    return text.sanitize_delimiters(titles)


# -- nested documents ---------------------------------------------------------------------------


def _flat_orders(t: Tables) -> DataFrame:
    return payloads.flatten_orders(payloads.parse_documents(t.order_docs(), "order"))


@query
def flatten_orders(t: Tables) -> DataFrame:
    return _flat_orders(t)


@query
def flatten_completeness(t: Tables) -> DataFrame:
    orders = payloads.parse_documents(t.order_docs(), "order")
    store = payloads.parse_documents(t.store_order_docs(), "store_order")
    ids = quality.reconcile_ids(
        payloads.flatten_store_orders(store), payloads.flatten_store_line_items(store), "order_id"
    )
    found = quality.flatten_completeness(
        orders, "id", payloads.flatten_orders(orders), "shipbob_order_id"
    )
    return found.select(
        "*", *[ids.select(c).scalar().alias(c) for c in ("header_ids", "line_ids")]
    )


@query
def lost_ids(t: Tables) -> DataFrame:
    """Orders that flattening loses: documents without items, and headers without lines."""
    orders = payloads.parse_documents(t.order_docs(), "order")
    store = payloads.parse_documents(t.store_order_docs(), "store_order")
    lost = quality.differing_ids(orders, "id", payloads.flatten_orders(orders), "shipbob_order_id")
    bare = quality.differing_ids(
        payloads.flatten_store_orders(store), "order_id", payloads.flatten_store_line_items(store), "order_id"
    )
    return lost.withColumn("what", F.lit("order")).unionByName(bare.withColumn("what", F.lit("header")))


@query
def flatten_products(t: Tables) -> DataFrame:
    return payloads.flatten_products(payloads.parse_documents(t.product_docs(), "product"))


@query
def active_variants(t: Tables) -> DataFrame:
    return payloads.active_variants(
        payloads.parse_documents(t.store_product_docs(), "store_product")
    )


@query
def flatten_store_orders(t: Tables) -> DataFrame:
    flat = payloads.flatten_store_orders(
        payloads.parse_documents(t.store_order_docs(), "store_order")
    )
    # Amounts arrive as text; engines print doubles differently.
    money = [
        "subtotal_price", "total_line_items_price", "total_tax", "total_discounts",
        "total_shipping_fee", "total_price",
    ]
    return flat.withColumns({c: numeric.to_number(F.col(c)) for c in money})


@query
def flatten_store_line_items(t: Tables) -> DataFrame:
    flat = payloads.flatten_store_line_items(
        payloads.parse_documents(t.store_order_docs(), "store_order")
    )
    return flat.withColumn("price", numeric.to_number(F.col("price")))


@query
def flatten_campaigns(t: Tables) -> DataFrame:
    flat = payloads.flatten_campaigns(payloads.parse_documents(t.campaign_docs(), "campaign"))
    lists = ["included_audience", "excluded_audience"]
    return flat.withColumns({c: F.array_join(c, "|") for c in lists})


@query
def flatten_messages(t: Tables) -> DataFrame:
    flat = payloads.flatten_messages(payloads.parse_documents(t.message_docs(), "message"))
    return flat.withColumn("send_time", dates.wall_clock_text(F.col("send_time")))


@query
def json_path_default(t: Tables) -> DataFrame:
    props = F.col("props")
    return t.table("events").select(
        "event_id",
        json_paths.path_or_default(props, "$.k", 0, "bigint").alias("k"),
        json_paths.path_or_default(props, "$.absent", 0, "bigint").alias("absent"),
        json_paths.estimated_recipients(
            F.concat(F.lit('{"data": {"attributes": {"estimated_recipient_count": '),
                     F.col("user_id").cast("string"), F.lit("}}}"))
        ).alias("recipients"),
    )


# -- dimension -------------------------------------------------------------------------------------


@query
def dimension_upsert(t: Tables) -> DataFrame:
    merged, _ = dimension.upsert(t.product_metadata(), t.product_changes(), CHANGE_TIME)
    return merged


@query
def dimension_rejects(t: Tables) -> DataFrame:
    _, rejected = dimension.upsert(t.product_metadata(), t.product_changes(), CHANGE_TIME)
    return rejected


@query
def dimension_listing(t: Tables) -> DataFrame:
    merged, _ = dimension.insert(t.product_metadata(), t.product_changes(), CHANGE_TIME)
    total = merged.agg(F.count("*")).scalar()
    return dimension.listing(merged).select(
        "inventory_id", "product_name", "created_at", total.alias("total_products")
    )


# -- scalar functions ----------------------------------------------------------------------------


@query
def scalar_strings(t: Tables) -> DataFrame:
    email = F.when(F.col("c_acctbal") >= 0, t.email())
    name = F.col("c_name")
    return t.table("customer").select(
        "c_custkey",
        text.tidy_value(F.concat(F.lit("(In stock) "), name)).alias("tidy"),
        text.hash_hex(F.lower(F.coalesce(email, F.lit("")))).alias("hashed"),
        text.mask_email(email).alias("email_masked"),
        text.mask_email(name).alias("not_an_email_masked"),
        text.mask_name(name).alias("name_masked"),
        text.delimiter_safe(F.concat(F.lit('a,"'), name)).alias("safe"),
        text.blank_commas(F.concat(F.lit("a,"), name)).alias("blanked"),
        F.format_string("• %s: %s", "c_mktsegment", "c_custkey").alias("message"),
    )


@query
def scalar_dates(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    parts = dates.day_parts(day)
    stamp = F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T23:30:00-04:00"))
    return t.table("orders").select(
        "o_orderkey",
        day.alias("day"),
        dates.month_start(day).alias("month"),
        dates.days_between(day, F.lit(AS_OF)).alias("age_days"),
        F.date_sub(day, 90).alias("minus_90"),
        dates.plus_days(day, F.col("o_totalprice") / 10000).alias("plus_days"),
        dates.wall_clock_text(stamp).alias("clock"),
        dates.wall_clock_text(stamp, "T").alias("clock_t"),
        dates.wall_clock(stamp).cast("date").alias("clock_day"),
        parts["year"].alias("year"),
        parts["month"].alias("month_part"),
        parts["day"].alias("day_part"),
        dates.compose_day(parts["year"], parts["month"], parts["day"]).alias("composed"),
        dates.parse_day(F.lit("")).alias("blank_day"),
    )


@query
def scalar_math(t: Tables) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    return t.table("part").select(
        "p_partkey",
        numeric.percent(size, F.lit(48)).alias("pct"),
        numeric.ratio_or_zero(price, size - 25, 365).alias("cover"),
        numeric.ratio(price, size - 25).alias("quotient"),
        numeric.whole_units(price * -0.5).alias("cut"),
        numeric.half_even(size / 2).alias("half_even"),
        numeric.to_number(F.col("p_brand")).alias("not_a_number"),
        numeric.to_number(size.cast("string")).alias("a_number"),
        reporting.severity_band(size * 3).alias("band"),
    )
