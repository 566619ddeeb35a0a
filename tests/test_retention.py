"""Retention as of a day: full computation on cut inputs, state merged day by day, ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.plans import customers, jobs, publish
from granary.sources import scans
from granary.sources.stored import StoredTable
from tests.test_stored import spoil

COHORT = customers.COHORT_START
D = lambda n: COHORT + dt.timedelta(days=n)
LINE = "order_number string, customer_email string, purchase_date timestamp_ntz, order_date date"


def lines(spark, cells):
    """(order, email, purchase day, filed day) as days after the cohort start."""
    stamp = lambda n: None if n is None else dt.datetime.combine(D(n), dt.time(23))
    return spark.createDataFrame([(str(o), e, stamp(p), D(f)) for o, e, p, f in cells], LINE)


def orders(seed):
    """History and recurring orders that overlap, differ in day and customer, and repeat."""
    rng = random.Random(seed)
    mails = ["a", "b", "c", "d", "e", "f", "", None]
    history = [(rng.randrange(40), rng.choice(mails), rng.choice([None, *range(-30, 60)]), 0) for _ in range(60)]
    recurring = []
    for _ in range(70):
        filed = rng.randrange(-10, 80)
        recurring.append((rng.randrange(20, 80), rng.choice(mails), rng.choice([None, filed, filed, filed, filed - 3, filed + 2]), filed))
    return history, recurring + recurring[:20]


def by_hand(history, recurring, day):
    """Cohorts on a day, from the definition."""
    known = [r for r in recurring if 0 <= r[3] <= day]
    filed = {r[0] for r in known}
    counted = [r for r in history if r[2] is not None and r[2] <= day and r[0] not in filed] + [r for r in known if r[2] is not None]
    days = {}
    for _, mail, bought, _ in counted:
        if mail:
            days.setdefault(mail, set()).add(bought)
    cohorts = {}
    for own in days.values():
        later = sorted(d for d in own if d >= 0)
        month = D(later[0]).replace(day=1) if later else None
        gaps = [d - later[0] for d in later[1:]]
        cohorts.setdefault(month, []).append([any(1 <= g <= n for g in gaps) for n in (30, 60, 90)])
    return {m: (len(f), *(sum(x[i] for x in f) for i in range(3))) for m, f in cohorts.items()}


def shown(df):
    return {r.cohort_month: (r.total_customers, r.retained_30d_count, r.retained_60d_count, r.retained_90d_count) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_a_range_equals_each_day_by_hand(spark, seed):
    history, recurring = orders(seed)
    h, r = lines(spark, history), lines(spark, recurring)
    got = {}
    for row in customers.retention_range(h, r, D(-5), D(85)).collect():
        got.setdefault(row.report_date, {})[row.cohort_month] = (row.total_customers, row.retained_30d_count, row.retained_60d_count, row.retained_90d_count)
        assert row.retained_60d_pct == round(100 * row.retained_60d_count / row.total_customers + 1e-9, 2)
    for n in range(-5, 86):
        assert got.get(D(n), {}) == by_hand(history, recurring, n), n
    assert shown(customers.retention_on(h, r, D(40))) == by_hand(history, recurring, 40)
    assert customers.retention_range(h, r, D(7), D(7)).count() == len(by_hand(history, recurring, 7))


def tables(spark, tmp_path, history, recurring):
    """All tables by day; order lines as a stored table whose other columns are null."""
    null = {f.name: F.lit(None).cast(f.type) for f in schemas.ORDER_DETAILS.fields if f.name not in LINE}
    root = str(tmp_path / "orders")
    publish.publish_range(lines(spark, recurring).withColumns(null), schemas.ORDER_DETAILS, root)
    state, left = (StoredTable(spark, str(tmp_path / e.name), e) for e in (schemas.CUSTOMER_DAYS, schemas.OPEN_HISTORY))
    return {"order_details": StoredTable(spark, root, schemas.ORDER_DETAILS), "historic_order_data": lines(spark, history),
            "customer_days": state, "open_history": left}


def test_merged_days_equal_a_full_computation(spark, tmp_path):
    history, recurring = orders(3)
    t = tables(spark, tmp_path, history, recurring)
    # Not every day has a run; the next one catches up.
    for n in (5, 20, 21, 22, 45, 79):
        jobs.advance_customers(t, D(n))
        assert shown(jobs.REPORTS["retention_by_cohort"].build(t, D(n))) == by_hand(history, recurring, n), n
    jobs.advance_customers(t, D(22))
    assert shown(jobs.REPORTS["retention_by_cohort"].build(t, D(22))) == by_hand(history, recurring, 22)
    # A day without a state is computed from all orders.
    assert shown(jobs.REPORTS["retention_by_cohort"].build(t, D(23))) == by_hand(history, recurring, 23)


def test_a_day_reads_one_day_of_orders(spark, tmp_path):
    history, recurring = orders(4)
    recurring.append((200, "a", 31, 31))
    t = tables(spark, tmp_path, history, recurring)
    jobs.advance_customers(t, D(30))
    spoil(t["order_details"].root, f"order_date={D(31)}")
    t["historic_order_data"] = t["historic_order_data"].withColumn("order_number", F.raise_error(F.lit("history was read")))
    jobs.advance_customers(t, D(31))
    assert shown(jobs.REPORTS["retention_by_cohort"].build(t, D(31))) == by_hand(history, recurring, 31)


def test_published_days_and_back_fills_agree(spark, tmp_path):
    history, recurring = orders(5)
    t = {n: x for n, x in tables(spark, tmp_path, history, recurring).items() if n in ("order_details", "historic_order_data")}
    one, many, staging = str(tmp_path / "one"), str(tmp_path / "many"), str(tmp_path / "st")
    for n in (29, 30, 31):
        jobs.run_report("retention_by_cohort", t, one, staging, D(n))
    jobs.backfill_report("retention_by_cohort", t, many, staging, D(29), D(31))
    read = lambda root: sorted(map(repr, scans.read_parquet_table(spark, root, schemas.RETENTION).collect()))
    assert read(one) == read(many) != []


def test_empty_inputs(spark):
    none = lines(spark, [(1, "a", 1, 1)]).limit(0)
    assert customers.retention_range(none, none, D(0), D(9)).count() == 0
    assert customers.retention_on(none, none, D(0)).count() == 0
