"""Customer retention, channel counts and the privacy-masked line items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import dates, numeric, text
from granary.operators import membership
from granary.schemas import CUSTOMER_DAYS, DAILY_ORDER_COUNT, OBFUSCATED_LINE_ITEMS, OPEN_HISTORY, RETENTION

# First order date that counts, and the retention windows in days.
COHORT_START = dt.date(2023, 1, 1)
RETENTION_DAYS = (30, 60, 90)


def order_history(
    history: DataFrame, recurring: DataFrame, cohort_start: dt.date | str = COHORT_START
) -> DataFrame:
    """Recurring orders from ``cohort_start`` on, plus history they do not contain."""
    return membership.history_union(
        history,
        recurring,
        recurring_filter=F.col("order_date") >= dates.day_lit(cohort_start),
    )


def order_day_history(
    history: DataFrame, recurring: DataFrame, cohort_start: dt.date | str = COHORT_START
) -> DataFrame:
    """``order_history`` reduced to distinct (order, e-mail, day) before the anti join, which
    then moves one row an order instead of its lines. All that retention needs."""

    def reduced(lines: DataFrame) -> DataFrame:
        day = F.to_date("purchase_date").alias("purchase_date")
        return lines.select("order_number", "customer_email", day).distinct()

    kept = recurring.filter(F.col("order_date") >= dates.day_lit(cohort_start))
    return membership.history_union(reduced(history), reduced(kept))


def _order_days(orders: DataFrame) -> DataFrame:
    """Distinct (email, day) pairs: a customer has at most one row per calendar day."""
    return (
        orders.filter(F.col("purchase_date").isNotNull() & (F.col("customer_email") != ""))
        .select(F.col("customer_email").alias("email"), F.to_date("purchase_date").alias("day"))
        .distinct()
    )


def _counted_day(cohort_start: dt.date | str) -> Column:
    return F.when(F.col("day") >= dates.day_lit(cohort_start), F.col("day"))


def first_orders(orders: DataFrame, cohort_start: dt.date | str = COHORT_START) -> DataFrame:
    """First order day on or after ``cohort_start`` per customer."""
    return (
        _order_days(orders)
        .filter(F.col("day") >= dates.day_lit(cohort_start))
        .groupBy("email")
        .agg(F.min("day").alias("first_order_date"))
    )


def retention_flags(orders: DataFrame, cohort_start: dt.date | str = COHORT_START) -> DataFrame:
    """Per customer, whether an order followed 1..30, 1..60 and 1..90 days after the first.

    A customer with orders only before ``cohort_start`` keeps a row without first date.
    """
    first = F.min(_counted_day(cohort_start)).over(Window.partitionBy("email"))
    since_first = dates.days_between(F.col("first_order_date"), F.col("day"))
    return (
        _order_days(orders)
        .withColumn("first_order_date", first)
        .groupBy("email", "first_order_date")
        .agg(
            *[
                F.max(F.when(since_first.between(1, n), 1).otherwise(0)).alias(f"retained_{n}d")
                for n in RETENTION_DAYS
            ]
        )
    )


def retention_by_cohort(flags: DataFrame, matured_by: dt.date | str | None = None) -> DataFrame:
    """Customers and retention per month of first order.

    ``matured_by`` leaves out customers whose longest window had not ended on that day.
    """
    if matured_by is not None:
        last_first = dates.to_day(matured_by) - dt.timedelta(days=max(RETENTION_DAYS))
        flags = flags.filter(F.col("first_order_date") <= dates.day_lit(last_first))
    total = F.count("*")
    measures = [total.alias("total_customers")]
    for n in RETENTION_DAYS:
        kept = F.sum(f"retained_{n}d")
        measures.append(kept.alias(f"retained_{n}d_count"))
        measures.append(numeric.percent(kept, total).alias(f"retained_{n}d_pct"))
    return (
        flags.groupBy(dates.month_start(F.col("first_order_date")).alias("cohort_month"))
        .agg(*measures)
        .select(*RETENTION.columns)
    )


def as_of_day(history: DataFrame, recurring: DataFrame, day: dt.date | str) -> tuple[DataFrame, DataFrame]:
    """The inputs of retention as they were on ``day``: history bought and recurring orders
    filed by then. A history order counts until the day its number is filed as recurring."""
    bought = F.to_date("purchase_date") <= dates.day_lit(day)
    return history.filter(bought), recurring.filter(F.col("order_date") <= dates.day_lit(day))


def retention_on(
    history: DataFrame, recurring: DataFrame, day: dt.date | str, cohort_start: dt.date | str = COHORT_START
) -> DataFrame:
    """``retention_by_cohort`` of the orders known on ``day``."""
    orders = order_day_history(*as_of_day(history, recurring, day), cohort_start)
    return retention_by_cohort(retention_flags(orders, cohort_start))


# -- retention from a state per customer ------------------------------------------------------
#
# The flags of a customer follow from the two earliest distinct days on or after the cohort
# start, and the two earliest of a union are the two earliest of its parts' two earliest. So a
# customer's state has two days, and a day's orders are merged into it without the older ones.


def _two_days(days: Column) -> list[Column]:
    """The two earliest of an array of distinct days as columns of the state."""
    ordered = F.slice(F.sort_array(days), 1, 2)
    return [F.get(ordered, 0).alias("first_day"), F.get(ordered, 1).alias("second_day")]


def _state(days: DataFrame, cohort_start: dt.date | str) -> DataFrame:
    """State of each email in ``days(email, day)``; days before the cohort start, and null
    ones, keep a customer without days. Sets are merged before the shuffle and hold calendar
    days, so a customer with very many orders is a small row."""
    held = days.groupBy("email").agg(F.collect_set(_counted_day(cohort_start)).alias("days"))
    return held.select("email", *_two_days(F.col("days")))


def _state_days(state: DataFrame) -> DataFrame:
    """A state as ``(email, day)`` rows, at least one for each customer."""
    return state.select("email", F.explode(F.array("first_day", "second_day")).alias("day"))


def _day_rows(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("purchase_date").isNotNull() & (F.col("customer_email") != "")).select(
        F.col("customer_email").alias("email"), F.to_date("purchase_date").alias("day")
    )


def begin_state(
    history: DataFrame, recurring: DataFrame, day: dt.date | str, cohort_start: dt.date | str = COHORT_START
) -> tuple[DataFrame, DataFrame]:
    """(state of recurring customers, history orders not filed as recurring) on ``day``.

    The history keeps orders bought after ``day``; they count once their day has come.
    """
    kept = recurring.filter(F.col("order_date").between(dates.day_lit(cohort_start), dates.day_lit(day)))
    orders = history.select("order_number", F.col("customer_email").alias("email"), F.to_date("purchase_date").alias("purchase_day"))
    counted = F.col("purchase_day").isNotNull() & (F.col("email") != "")
    left = orders.filter(counted).distinct().join(kept.select("order_number").distinct(), "order_number", "left_anti")
    return _state(_day_rows(kept), cohort_start), left.select(*OPEN_HISTORY.columns)


def advance_state(
    state: DataFrame, open_history: DataFrame, new_orders: DataFrame, cohort_start: dt.date | str = COHORT_START
) -> tuple[DataFrame, DataFrame]:
    """State and open history once ``new_orders``, the recurring orders of the days since, are
    merged in. Reads no older orders."""
    kept = new_orders.filter(F.col("order_date") >= dates.day_lit(cohort_start))
    days = _state_days(state).unionByName(_day_rows(kept))
    left = open_history.join(kept.select("order_number").distinct(), "order_number", "left_anti")
    return _state(days, cohort_start).select(*CUSTOMER_DAYS.columns), left.select(*OPEN_HISTORY.columns)


def state_flags(
    state: DataFrame, open_history: DataFrame, day: dt.date | str, cohort_start: dt.date | str = COHORT_START
) -> DataFrame:
    """``retention_flags`` on ``day`` from the state of that day."""
    bought = open_history.filter(F.col("purchase_day") <= dates.day_lit(day)).select("email", F.col("purchase_day").alias("day"))
    return _flags(_state(_state_days(state).unionByName(bought), cohort_start))


def _flags(state: DataFrame) -> DataFrame:
    since = dates.days_between(F.col("first_day"), F.col("second_day"))
    kept = [F.coalesce((since <= n).cast("int"), F.lit(0)).alias(f"retained_{n}d") for n in RETENTION_DAYS]
    return state.select("email", F.col("first_day").alias("first_order_date"), *kept, *[c for c in state.columns if c in ("_from", "_to")])


def retention_range(
    history: DataFrame,
    recurring: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    cohort_start: dt.date | str = COHORT_START,
) -> DataFrame:
    """``retention_on`` of every day in [start, end] as one plan, keyed by ``report_date``.

    An order day counts for a customer from the day it is known, and one of the history until
    its number is filed. Days that count over the whole range are reduced to a state; the
    others cut the range into pieces in which nothing changes. Cohorts then change by what
    begins and ends on a day, so a customer is a row a piece and not a row a day.
    """
    start, end = dates.to_day(start), dates.to_day(end)
    past = dates.day_lit(end + dt.timedelta(days=1))
    kept = recurring.filter(F.col("order_date").between(dates.day_lit(cohort_start), dates.day_lit(end)))
    filed = kept.groupBy("order_number").agg(F.min("order_date").alias("until"))
    bought = history.select("order_number", F.col("customer_email").alias("email"), F.to_date("purchase_date").alias("day")).distinct()
    known = kept.filter(F.col("purchase_date").isNotNull()).select(
        F.col("customer_email").alias("email"), F.to_date("purchase_date").alias("day"), F.col("order_date").alias("since"), past.alias("until")
    )
    before = bought.join(filed, "order_number", "left").select("email", "day", F.col("day").alias("since"), F.coalesce("until", past).alias("until"))
    spans = (
        known.unionByName(before)
        .filter((F.col("email") != "") & F.col("day").isNotNull())
        .withColumns({"since": F.greatest("since", dates.day_lit(start)), "until": F.least("until", past)})
        .filter("since < until")
        .withColumn("day", _counted_day(cohort_start))
    )
    steady = (F.col("since") == dates.day_lit(start)) & (F.col("until") == past)
    held = spans.groupBy("email").agg(
        F.collect_set(F.when(steady, F.col("day"))).alias("days"),
        F.max(steady).alias("steady"),
        F.collect_set(F.when(~steady, F.struct("day", "since", "until"))).alias("moving"),
    )
    marks = F.array_sort(F.array_distinct(F.concat(F.array(dates.day_lit(start)), F.transform("moving", lambda m: m["since"]), F.transform("moving", lambda m: m["until"]))))
    ordered = held.select("email", "steady", "moving", F.slice(F.sort_array("days"), 1, 2).alias("days"), F.filter(marks, lambda d: d < past).alias("marks"))
    pieces = ordered.select("*", F.posexplode("marks").alias("_at", "_from")).withColumn("_to", F.coalesce(F.get("marks", F.col("_at") + 1), past))
    active = F.filter("moving", lambda m: (m["since"] <= F.col("_from")) & (F.col("_from") < m["until"]))
    moved = F.filter(F.transform(active, lambda m: m["day"]), lambda d: d.isNotNull())
    state = pieces.filter(F.col("steady") | (F.size(active) > 0)).select(
        "email", "_from", "_to", *_two_days(F.array_distinct(F.concat("days", moved)))
    )
    measures = ["total_customers", *[f"retained_{n}d" for n in RETENTION_DAYS]]
    change = lambda day, sign: F.struct(F.col(day).alias("report_date"), *[(F.lit(sign) * F.col(m)).alias(m) for m in measures])
    changes = (
        _flags(state).withColumns({"total_customers": F.lit(1), "cohort_month": dates.month_start(F.col("first_order_date"))})
        .select("cohort_month", F.explode(F.array(change("_from", 1), change("_to", -1))).alias("c"))
        .select("cohort_month", "c.*")
        .groupBy("cohort_month", "report_date")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    # A row for each cohort and day of the range, however few of them change.
    days = F.explode(F.sequence(dates.day_lit(start), dates.day_lit(end))).alias("report_date")
    every = changes.select("cohort_month").distinct().select("cohort_month", days).select("*", *[F.lit(0).alias(m) for m in measures])
    running = Window.partitionBy("cohort_month").orderBy("report_date").rangeBetween(Window.unboundedPreceding, 0)
    total = F.col("total_customers")
    shares = [(F.col(f"retained_{n}d").alias(f"retained_{n}d_count"), numeric.percent(F.col(f"retained_{n}d"), total).alias(f"retained_{n}d_pct")) for n in RETENTION_DAYS]
    return (
        changes.unionByName(every)
        .groupBy("cohort_month", "report_date")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .withColumns({m: F.sum(m).over(running) for m in measures})
        .filter((total > 0) & (F.col("report_date") <= dates.day_lit(end)))
        .select("report_date", "cohort_month", "total_customers", *[c for pair in shares for c in pair])
        .select(*RETENTION.columns, "report_date")
    )


def daily_order_counts(
    orders: DataFrame, start: dt.date | str, end: dt.date | str | None = None
) -> DataFrame:
    """Distinct orders per channel and day for one day or for every day in [start, end].

    The exact distinct count runs as two aggregates, first on (channel, day, order) and
    then on (channel, day), so a dominant channel does not end up in one task.
    """
    day = F.to_date(F.col("order_date"))
    in_range = orders.filter(day.between(dates.day_lit(start), dates.day_lit(end or start)))
    return (
        in_range.groupBy(
            F.col("channel_id").cast("string").alias("channel_id"),
            F.col("channel_name").cast("string").alias("channel_name"),
            day.alias("order_date"),
        )
        .agg(F.countDistinct("order_number").alias("order_cnt"))
        .select(*DAILY_ORDER_COUNT.columns, "order_date")
    )


def obfuscated_line_items(
    history: DataFrame,
    recurring: DataFrame,
    snapshot_date: dt.date | str,
    salt: str | None = None,
) -> DataFrame:
    """All order lines with hashed ids and masked names; state and country are kept.

    A null e-mail hashes like an empty one.
    """
    lines = membership.history_union(history, recurring)
    email = F.col("customer_email")
    replaced = {
        "customer_hash": text.hash_hex(F.lower(F.coalesce(email, F.lit(""))), salt),
        "shipbob_order_id_hash": text.hash_hex(F.col("shipbob_order_id").cast("string"), salt),
        "customer_email_masked": text.mask_email(email),
        "customer_name_masked": text.mask_name(F.col("customer_name")),
        "order_month": dates.month_start(F.col("order_date").try_cast("date")),
        "snapshot_date": dates.day_lit(snapshot_date),
        "created_date": F.col("created_date").try_cast("date"),
    }
    return lines.select(
        *[
            replaced.get(f.name, F.col(f.name).cast(f.type)).alias(f.name)
            for f in OBFUSCATED_LINE_ITEMS.fields
        ]
    )
