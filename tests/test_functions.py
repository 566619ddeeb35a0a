import datetime as dt

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import dates, json_paths, moments, numeric, text


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_tidy_name_matches_tidy_value(spark):
    names = ["In stock (kg)", "  MO # ", "Variant code / SKU", "already_fine", "Ünit-Cost"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    values = [r[0] for r in df.select(text.tidy_value(F.col("name"))).collect()]
    assert values == [text.tidy_name(n) for n in names]
    assert values[0] == "in_stock_kg"


def test_tidy_names_renames_a_frame(spark):
    df = spark.createDataFrame([(1, 2)], ["Planned Qty.", "MO"])
    assert text.tidy_names(df).columns == ["planned_qty", "mo"]


def test_sanitize_touches_only_strings(spark):
    df = spark.createDataFrame([('say "a,b"\nc', 1), (None, 2)], "s string, n int")
    assert [tuple(r) for r in text.sanitize_delimiters(df).collect()] == [("say 'a;b' c", 1), (None, 2)]


@pytest.mark.parametrize(
    "given_email, kept",
    [("o'brien@x.com", "o'brien@x.com"), ("josé@example.com", "josé@example.com"), ("a!b@x.com", "a!b@x.com"),
     ("ann@bücher.de", "ann@bücher.de"), ("a..b@x.com", None), (".a@x.com", None), ("a.@x.com", None),
     ("a@-x.com", None), ("a@x-.com", None), ("a@x..com", None), ("a@1.2.3.4", None), ("a b@x.com", None),
     ("x" * 64 + "@x.com", "x" * 64 + "@x.com"), ("x" * 65 + "@x.com", None),
     ("a@b.co", "a@b.co"), ("", None), (None, None), ("not-an-email", None), ("a@b@c", None), ("a@b", None)],
)
def test_email_or_default(spark, given_email, kept):
    row = one(spark, v=text.email_or_default(F.lit(given_email).cast("string")))
    assert row.v == (kept or "unknown@unknown.com")


@pytest.mark.parametrize("sku, expected", [("", "No SKU"), (None, "No SKU"), ("A-1", "A-1")])
def test_sku_or_default(spark, sku, expected):
    assert one(spark, v=text.sku_or_default(F.lit(sku).cast("string"))).v == expected


def test_masks(spark):
    row = one(
        spark,
        email=text.mask_email(F.lit("jo@shop.com")),
        odd=text.mask_email(F.lit("nobody")),
        gone=text.mask_email(F.lit(None).cast("string")),
        name=text.mask_name(F.lit("Jo")),
        no_name=text.mask_name(F.lit(None).cast("string")),
    )
    assert tuple(row) == ("***@shop.com", "***", None, "J***", None)


def test_hash_is_upper_case_and_salted(spark):
    row = one(spark, plain=text.hash_hex(F.lit("a")), salted=text.hash_hex(F.lit("a"), "pepper"))
    assert row.plain == "CA978112CA1BBDCAFAC231B39A23DC4DA786EFF8147C4E72B9807785AFEE48BB"
    assert row.salted != row.plain


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_wall_clock_ignores_offset_and_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamp = F.lit("2024-10-27T23:30:00-04:00")
        row = one(
            spark,
            day=dates.wall_clock(stamp).cast("date"),
            shown=dates.wall_clock_text(stamp),
            iso=dates.wall_clock_text(stamp, "T"),
            bad=dates.wall_clock(F.lit("not a time")),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.day == dt.date(2024, 10, 27)
    assert (row.shown, row.iso) == ("2024-10-27 23:30:00", "2024-10-27T23:30:00")
    assert row.bad is None


@pytest.mark.parametrize(
    "value, expected",
    [("2024-02-29", dt.date(2024, 2, 29)), ("2024-2-9", dt.date(2024, 2, 9)), ("", None), (None, None),
     ("2024-02-30", None), ("02/03/2024", None)],
)
def test_parse_day(spark, value, expected):
    assert one(spark, d=dates.parse_day(F.lit(value).cast("string"))).d == expected


def test_day_parts_round_trip(spark):
    parts = dates.day_parts(F.lit(dt.date(2024, 3, 7)))
    row = one(spark, **parts, back=dates.compose_day(*parts.values()))
    assert tuple(row) == ("2024", "03", "07", dt.date(2024, 3, 7))


def test_driver_side_days():
    now = dt.datetime(2025, 1, 1, 2, 0)
    assert dates.report_day(now) == dt.date(2024, 12, 31)
    assert dates.local_day(now) == dt.date(2024, 12, 31)
    assert dates.to_day("2024-05-06") == dates.to_day(dt.datetime(2024, 5, 6, 9)) == dt.date(2024, 5, 6)


def test_ratios(spark):
    one_, zero = F.lit(1.0), F.lit(0.0)
    row = one(
        spark,
        null=numeric.ratio(one_, zero),
        zero=numeric.ratio_or_zero(one_, zero),
        nan=numeric.ratio_or_zero(F.lit(float("nan")), one_),
        capped=numeric.ratio_or_zero(F.lit(1000), one_, 365),
        pct=numeric.percent(F.lit(1), F.lit(3)),
    )
    assert tuple(row) == (None, 0.0, 0.0, 365.0, 33.33)


def test_rounding_rules(spark):
    row = one(
        spark,
        **{f"e{i}": numeric.half_even(F.lit(v)) for i, v in enumerate([0.5, 1.5, 2.5, -0.5])},
        cut=numeric.whole_units(F.lit(-2.9)),
        almost=numeric.whole_units(F.lit(2.9999999999999996)),
        below=numeric.whole_units(F.lit(2.99)),
    )
    assert tuple(row) == (0, 2, 2, 0, -2, 3, 2)


def test_nan_and_numbers(spark):
    row = one(
        spark,
        nan=numeric.nan_to_null(F.lit(float("nan"))),
        kept=numeric.nan_to_null(F.lit(1.5)),
        text=numeric.to_number(F.lit("abc")),
        number=numeric.to_number(F.lit("1e3")),
    )
    assert tuple(row) == (None, 1.5, None, 1000.0)


def test_json_paths(spark):
    doc = F.lit('{"data": {"attributes": {"estimated_recipient_count": 7, "html": "<p>"}}}')
    row = one(
        spark,
        n=json_paths.estimated_recipients(doc),
        none=json_paths.estimated_recipients(F.lit('{"data": {}}')),
        broken=json_paths.path_or_default(F.lit("{oops"), "$.a", 3, "int"),
        html=json_paths.html_template(doc),
        no_html=json_paths.html_template(F.lit('{"data": null}')),
    )
    assert tuple(row) == (7, 0, 3, "<p>", None)


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.integers(0, 40), min_size=1, max_size=30),
    st.integers(0, 20),
)
def test_moments_match_pandas_on_the_zero_filled_series(spark, sold, zeros):
    series = pd.Series([float(x) for x in sold] + [0.0] * zeros)
    df = spark.createDataFrame([(float(x),) for x in sold if x], "x double")
    sums = df.agg(*[F.coalesce(c, F.lit(0.0)).alias(f"s{i + 1}") for i, c in enumerate(moments.power_sums(F.col("x")))])
    n = F.lit(len(series))
    row = sums.select(moments.sample_skewness(n).alias("s"), moments.sample_excess_kurtosis(n).alias("k")).first()
    for got, expected in ((row.s, series.skew()), (row.k, series.kurt())):
        if pd.isna(expected):
            assert got is None
        else:
            assert got == pytest.approx(expected, abs=1e-6)
