import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.plans import customers
from granary.schemas import OBFUSCATED_LINE_ITEMS, ORDER_DETAILS

FIRST = dt.date(2023, 3, 10)


def purchases(spark, *cells):
    return spark.createDataFrame(
        [(e, dt.datetime.combine(d, dt.time(22)) if d else None) for e, d in cells],
        "customer_email string, purchase_date timestamp_ntz",
    )


def after(n):
    return FIRST + dt.timedelta(days=n)


@pytest.mark.parametrize(
    "repeat, flags",
    [(0, (0, 0, 0)), (1, (1, 1, 1)), (30, (1, 1, 1)), (31, (0, 1, 1)), (60, (0, 1, 1)), (61, (0, 0, 1)),
     (90, (0, 0, 1)), (91, (0, 0, 0))],
)
def test_retention_windows(spark, repeat, flags):
    df = purchases(spark, ("a", FIRST), ("a", after(repeat)))
    assert tuple(customers.retention_flags(df).first()) == ("a", FIRST, *flags)


def test_old_only_customers_form_the_null_cohort(spark, rows):
    df = purchases(spark, ("old", dt.date(2022, 5, 1)), ("mixed", dt.date(2022, 12, 31)), ("mixed", FIRST),
                   ("", FIRST), (None, FIRST), ("undated", None))
    flags = customers.retention_flags(df)
    assert rows(flags, "email") == [("mixed", FIRST, 0, 0, 0), ("old", None, 0, 0, 0)]
    assert rows(customers.first_orders(df)) == [("mixed", FIRST)]
    cohorts = rows(customers.retention_by_cohort(flags), "cohort_month")
    assert cohorts == [(None, 1, 0, 0.0, 0, 0.0, 0, 0.0), (dt.date(2023, 3, 1), 1, 0, 0.0, 0, 0.0, 0, 0.0)]


def test_cohort_percentages_and_maturity(spark, rows):
    df = purchases(spark, ("a", FIRST), ("a", after(5)), ("b", FIRST), ("c", after(1)), ("c", after(50)),
                   ("late", after(40)))
    flags = customers.retention_flags(df)
    assert rows(customers.retention_by_cohort(flags), "cohort_month")[0] == (
        dt.date(2023, 3, 1), 3, 1, 33.33, 2, 66.67, 2, 66.67)
    assert len(rows(customers.retention_by_cohort(flags, matured_by=after(91)))) == 1


def test_a_dominant_customer_is_reduced_before_the_window(spark):
    df = purchases(spark, ("a", FIRST)).crossJoin(spark.range(500))
    plan = customers.retention_flags(df)._jdf.queryExecution().executedPlan().toString()
    # Duplicate (email, day) rows are aggregated away below the exchange that feeds the window.
    assert plan.index("Window") < plan.rindex("HashAggregate(keys=[email")
    assert customers.retention_flags(df).count() == 1


def test_order_counts(spark, rows):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, "web", "A", day), (1, "web", "A", day), (1, "web", "B", day), (None, None, "C", day),
         (1, "web", "A", day + dt.timedelta(days=1))],
        "channel_id bigint, channel_name string, order_number string, order_date date",
    )
    one = rows(customers.daily_order_counts(df, day), F.col("channel_id").asc_nulls_last())
    assert one == [("1", "web", 2, day), (None, None, 1, day)]
    assert customers.daily_order_counts(df, day, "2024-01-31").count() == 3


def test_obfuscation_hides_people(spark):
    values = {f.name: {"bigint": 7, "timestamp_ntz": dt.datetime(2024, 2, 5, 23)}.get(f.type, f.name) for f in ORDER_DETAILS.fields}
    values |= {"customer_email": "Jo@Shop.com", "customer_name": "Jo Doe", "order_date": dt.date(2024, 2, 6)}
    schema = ORDER_DETAILS.struct(with_partition=True)
    lines = spark.createDataFrame(
        [tuple(values.values()), tuple((values | {"customer_email": None, "order_number": "x"}).values())], schema)
    out = customers.obfuscated_line_items(lines.limit(0), lines, "2024-03-01")
    assert out.columns == OBFUSCATED_LINE_ITEMS.columns and out.schema.simpleString() == OBFUSCATED_LINE_ITEMS.struct().simpleString()
    known, unknown = sorted(out.collect(), key=lambda r: r.customer_email_masked is None)
    assert (known.customer_email_masked, known.customer_name_masked) == ("***@Shop.com", "J***")
    assert known.order_month == dt.date(2024, 2, 1) and known.created_date == dt.date(2024, 2, 5)
    assert unknown.customer_email_masked is None
    # A null e-mail hashes like an empty one.
    assert unknown.customer_hash == "E3B0C44298FC1C149AFBF4C8996FB92427AE41E4649B934CA495991B7852B855"
    assert "Jo" not in str(known) and "City" not in str(known)
    salted = customers.obfuscated_line_items(lines.limit(0), lines, "2024-03-01", salt="s").first()
    assert salted.customer_hash not in (known.customer_hash, unknown.customer_hash)
