import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import schemas
from granary.operators import quality
from granary.schemas import (
    ENTITIES, FORMULAS, MANUFACTURING_ORDERS, MATERIAL_INVENTORY, ORDER_DETAILS, RUN_RATE,
    STORE_LINE_ITEMS, STORE_ORDERS, Entity, Field,
)

LINE = {
    "order_id": "1", "email": "a@b.co", "created_at": "2024-10-27T23:30:00-04:00", "order_date": "2024-10-27",
    "price": "2.5", "quantity": "3", "sku": "A,1", "title": "T", "variant_title": None, "line_item_name": "N",
}


def lines(spark, *changes):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*LINE, "extra"]])
    return spark.createDataFrame([tuple({**LINE, "extra": "x", **c}.values()) for c in changes], schema)


def errors(df, entity):
    return [r[0] for r in quality.check(df, entity).select(F.array_join(quality.ERRORS, "; ")).collect()]


def test_valid_rows_are_typed_and_trimmed_to_the_entity(spark):
    valid, invalid = quality.split(lines(spark, {}), STORE_LINE_ITEMS)
    assert invalid.count() == 0 and valid.columns == STORE_LINE_ITEMS.columns
    row = valid.first()
    assert (row.order_id, row.price, row.quantity, row.sku) == (1, 2.5, 3, "A 1")
    assert row.created_at == dt.datetime(2024, 10, 27, 23, 30) and row.order_date == dt.datetime(2024, 10, 27)


@pytest.mark.parametrize(
    "change, error",
    [
        ({"price": "-1"}, "price: below 0"),
        ({"price": "NaN"}, "price: below 0"),
        ({"quantity": "x"}, "quantity: not a bigint"),
        ({"quantity": "2.5"}, "quantity: not a bigint"),
        ({"quantity": "2.0"}, ""),
        ({"quantity": " 7 "}, ""),
        ({"quantity": "1e3"}, "quantity: not a bigint"),
        ({"quantity": "9007199254740993.0"}, ""),
        ({"title": None}, "title: required"),
        ({"created_at": "someday"}, "created_at: not a timestamp_ntz"),
        ({"email": None, "sku": None}, ""),
        ({"order_id": None, "price": "-2"}, "order_id: required; price: below 0"),
    ],
)
def test_rules(spark, change, error):
    assert errors(lines(spark, change), STORE_LINE_ITEMS) == [error]


def test_invalid_rows_come_back_untouched(spark):
    valid, invalid = quality.split(lines(spark, {}, {"quantity": "x", "sku": "B,2"}), STORE_LINE_ITEMS)
    assert valid.count() == 1
    row = invalid.first()
    assert (row.sku, row.quantity, row.extra, row.error) == ("B,2", "x", "x", "quantity: not a bigint")


def test_missing_column_is_an_error_unless_optional(spark):
    df = lines(spark, {}).drop("variant_title", "title")
    assert errors(df, STORE_LINE_ITEMS) == ["title: required"]


def test_defaults(spark):
    valid, _ = quality.split(lines(spark, {"email": "", "sku": ""}), STORE_LINE_ITEMS)
    assert (valid.first().email, valid.first().sku) == ("unknown@unknown.com", "No SKU")


def test_nan_becomes_null_before_the_rules(spark):
    nan = float("nan")
    columns = FORMULAS.columns
    base = {c: None for c in columns} | {
        "product_variant_code": 1.0, "ingredient_variant_code_sku_required": "RM-1",
        "quantity_required": 0.5, "current_stock_price": 2.0,
    }
    schema = T.StructType(
        [T.StructField(c, T.DoubleType() if isinstance(base[c], float) else T.StringType()) for c in columns]
    )
    df = spark.createDataFrame(
        [tuple(base.values()), tuple((base | {"quantity_required": nan}).values()),
         tuple((base | {"product_variant_code": nan}).values())], schema)
    assert errors(df, FORMULAS) == ["", "quantity_required: required", ""]
    third = quality.split(df, FORMULAS)[0].filter("product_variant_code is null")
    assert third.count() == 1


def test_manufacturing_dates(spark):
    text = {f.name: "1" for f in MANUFACTURING_ORDERS.fields} | {"created_date": "2024-01-05", "done_date": ""}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in text])
    df = spark.createDataFrame(
        [tuple(text.values()), tuple((text | {"done_date": "05/01/2024"}).values()),
         tuple((text | {"created_date": ""}).values())], schema)
    assert errors(df, MANUFACTURING_ORDERS) == ["", "done_date: not a date", "created_date: required"]


def test_booleans_and_required_numbers(spark):
    df = spark.createDataFrame([("true", "1"), ("maybe", None), ("Off", "2")], "flag string, n string")
    entity = Entity("e", (Field("flag", "boolean"), Field("n", "bigint")))
    assert errors(df, entity) == ["", "flag: not a boolean; n: required", ""]
    assert [tuple(r) for r in quality.split(df, entity)[0].collect()] == [(True, 1), (False, 2)]


def test_large_whole_numbers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993.0",)], "n string")
    entity = Entity("e", (Field("n", "bigint"),))
    assert quality.split(df, entity)[0].first().n == 9007199254740993


def test_require_valid(spark):
    assert quality.require_valid(lines(spark, {}), STORE_LINE_ITEMS).count() == 1
    with pytest.raises(quality.InvalidRowsError, match="quantity"):
        quality.require_valid(lines(spark, {}, {"quantity": "x"}), STORE_LINE_ITEMS)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["1", "0", "-1", "x", "", None, "2.5"]), min_size=1, max_size=12))
def test_valid_and_invalid_add_up(spark, quantities):
    df = lines(spark, *[{"quantity": q} for q in quantities])
    valid, invalid = quality.split(df, STORE_LINE_ITEMS)
    total = quality.summary(df, STORE_LINE_ITEMS).first()
    assert total.total_rows == len(quantities) == total.valid_rows + total.invalid_rows
    assert (valid.count(), invalid.count()) == (total.valid_rows, total.invalid_rows)
    assert total.valid_rows == sum(q in ("1", "0") for q in quantities)


def test_cleanse_keeps_rows_and_columns(spark):
    df = lines(spark, {"email": "bad", "price": "x"})
    row = quality.cleanse(df, STORE_LINE_ITEMS).first()
    assert (row.email, row.sku, row.price, row.extra) == ("unknown@unknown.com", "A 1", "x", "x")


def test_nan_to_null(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame([(nan, nan, "nan")], "a double, b double, c string")
    assert rows(quality.nan_to_null(df)) == [(None, None, "nan")]
    only_a = quality.nan_to_null(df, ["a", "c"]).first()
    assert only_a.a is None and only_a.b != only_a.b


def test_checks_stay_in_the_jvm(spark):
    plan = quality.check(lines(spark, {}), STORE_LINE_ITEMS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_every_cleaner_and_type_is_known():
    for entity in ENTITIES.values():
        assert len(set(entity.columns)) == len(entity.columns)
        for field in entity.fields:
            assert set(field.clean) <= set(quality.CLEANERS), field
    assert STORE_ORDERS.fields[1].clean == ("commas", "email")
    assert [f.name for f in MATERIAL_INVENTORY.fields if f.required][:2] == ["name", "units_of_measure"]
    assert ORDER_DETAILS.columns.index("shipping_method") == 10
    assert "active_fl" not in RUN_RATE.columns


def test_struct_from_annotations():
    class Model:
        a: int
        b: float | None
        c: str
        d: bool
        e: dt.datetime
        f: "dt.date | None"

    struct = schemas.struct_from_annotations(Model)
    assert [f.dataType.simpleString() for f in struct] == [
        "bigint", "double", "string", "boolean", "timestamp_ntz", "date",
    ]
    assert [f.nullable for f in struct] == [False, True, False, False, False, True]

    class Bad:
        x: list

    with pytest.raises(ValueError, match="unsupported type for column x"):
        schemas.struct_from_annotations(Bad)
