import datetime as dt
import json

import pytest

from granary.operators import quality
from granary.schemas import INVENTORY_DETAILS, ORDER_DETAILS
from granary.sources import payloads


def docs(spark, kind, *documents):
    df = spark.createDataFrame([(json.dumps(d),) for d in documents], "doc string")
    return payloads.parse_documents(df, kind)


def order(order_id, shipments, channel=None):
    return {
        "id": order_id,
        "created_date": "2024-10-27T23:30:00-04:00",
        "purchase_date": "2024-10-27T23:30:00-04:00",
        "order_number": f"N{order_id}",
        "status": "Fulfilled",
        "type": "DTC",
        "shipping_method": "Standard",
        "channel": channel,
        "recipient": {"name": "Jo", "email": "jo@shop.com", "address": {"city": "C", "state": "S", "country": "US"}},
        "shipments": shipments,
        "extra": {"ignored": True},
    }


def product(product_id, *item_ids):
    items = [{"id": i, "name": f"item {i}", "quantity": i % 5} for i in item_ids]
    return {"id": product_id, "sku": f"S{product_id}", "name": f"p {product_id}", "inventory_items": items}


def test_orders_are_flattened_to_the_last_level(spark, rows):
    shipments = [{"products": [product(1, 11, 12), product(2, 21, 22)]},
                 {"products": [product(3, 31, 32), product(4, 41, 42)]}]
    flat = payloads.flatten_orders(
        docs(spark, "order", order(1, shipments, {"id": 9, "name": "web"}), order(2, []),
             order(3, [{"products": []}]), order(4, [{"products": [product(5)]}]))
    )
    assert flat.columns == ORDER_DETAILS.columns
    assert [r[0] for r in rows(flat.select("inventory_id"), "inventory_id")] == [11, 12, 21, 22, 31, 32, 41, 42]
    first = flat.orderBy("inventory_id").first()
    assert (first.shipbob_order_id, first.product_id, first.inventory_qty, first.channel_name) == (1, 1, 1, "web")
    assert first.purchase_date == dt.datetime(2024, 10, 27, 23, 30)


def test_missing_channel_gives_nulls(spark):
    row = payloads.flatten_orders(docs(spark, "order", order(1, [{"products": [product(1, 11)]}]))).first()
    assert row.channel_id is None and row.channel_name is None and row.customer_address_country == "US"


def test_text_is_parsed_once(spark):
    listed = {"id": 1, "title": "a", "published_at": "2024-01-01T10:00:00-05:00", "variants": [variant(1, 3)]}
    for flat in (
        payloads.flatten_orders(docs(spark, "order", order(1, [{"products": [product(1, 11)]}]))),
        payloads.active_variants(docs(spark, "store_product", listed)),
    ):
        plan = flat._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1


def test_the_choice_among_copies_of_a_variant_is_stated(spark, rows):
    def listed(when, *variants):
        return {"id": 1, "title": "a", "published_at": when, "variants": list(variants)}

    early, late = "2024-01-01T10:00:00-05:00", "2024-02-01T10:00:00-05:00"
    nameless = [variant(None, 5) | {"title": t} for t in ("x", "y", "x")]
    pages = [listed(early, variant(1, 9), *nameless), listed(late, variant(1, 3)), listed(late, variant(1, 4)), listed(None, variant(2, 8)), listed("", variant(3, 8))]
    for order_ in (pages, pages[::-1]):
        out = payloads.active_variants(docs(spark, "store_product", *order_))
        got = rows(out.select("variant_id", "inventory_quantity", "variant_title"), "variant_id", "variant_title")
        assert [(i, q) for i, q, _ in got] == [(None, 5.0), (None, 5.0), (1, 4.0)]


def test_landed_files(spark, tmp_path, rows):
    for n in (1, 2):
        (tmp_path / f"page{n}.json").write_text(
            "\n".join(json.dumps(order(10 * n + k, [{"products": [product(1, 11)]}])) for k in (1, 2))
        )
    flat = payloads.flatten_orders(payloads.read_documents(spark, str(tmp_path), "order"))
    assert [r[0] for r in rows(flat.select("shipbob_order_id"), "shipbob_order_id")] == [11, 12, 21, 22]


def test_malformed_documents_fail(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"id": 1, "shipments": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        payloads.read_documents(spark, str(tmp_path), "order").collect()


def test_products(spark, rows):
    doc = {"id": 1, "sku": "A", "name": "a", "channel": {"id": 5, "name": "web"},
           "fulfillable_inventory_items": [{"id": 7, "name": "x", "quantity": 2}, {"id": 8, "name": "y", "quantity": 1}]}
    flat = payloads.flatten_products(docs(spark, "product", doc, {**doc, "fulfillable_inventory_items": []}))
    assert rows(flat, "inventory_id") == [(1, "A", "a", 5, "web", 7, "x", 2), (1, "A", "a", 5, "web", 8, "y", 1)]


def test_inventory_keeps_declared_columns(spark):
    doc = {f.name: (True if f.type == "boolean" else "n" if f.type == "string" else 4) for f in INVENTORY_DETAILS.fields}
    flat = payloads.project_inventory(docs(spark, "inventory", {**doc, "lots": [{"n": 1}]}))
    assert flat.columns == INVENTORY_DETAILS.columns and flat.first().total_onhand_quantity == 4


def variant(variant_id, quantity):
    return {"id": variant_id, "title": "t", "sku": f"V{variant_id}", "inventory_quantity": quantity}


def test_active_variants(spark, rows):
    listed = {"id": 1, "title": "a", "published_at": "2024-01-01T10:00:00-05:00",
              "variants": [variant(1, 3), variant(2, 0), variant(3, -1)]}
    hidden = {**listed, "id": 2, "published_at": None, "variants": [variant(4, 3)]}
    blank = {**listed, "id": 3, "published_at": "", "variants": [variant(5, 3)]}
    # The first page arrives twice.
    flat = payloads.active_variants(docs(spark, "store_product", listed, listed, hidden, blank))
    assert rows(flat) == [(1, "a", 1, "t", "V1", 3.0, dt.datetime(2024, 1, 1, 10, 0))]


def store_order(number, **changes):
    doc = {"order_number": number, "created_at": "2024-10-27T23:30:00-04:00", "email": "a@b.co",
           "subtotal_price": "10.5", "total_line_items_price": "10.5", "total_tax": "0", "total_discounts": "0",
           "total_shipping_price_set": {"shop_money": {"amount": "4.75"}}, "total_price": "15.25",
           "shipping_address": {"address1": "1 Main St", "city": "C", "province": "P", "country": "US"},
           "line_items": [{"price": "5", "quantity": 2, "sku": "", "title": "T", "variant_title": None, "name": "N"}]}
    return {**doc, **changes}


def test_store_orders(spark, rows):
    parsed = docs(spark, "store_order", store_order(1), store_order(2, shipping_address=None, line_items=[]),
                  store_order(3, total_shipping_price_set=None))
    headers = {r.order_id: r for r in payloads.flatten_store_orders(parsed).collect()}
    assert headers[1].order_date == "2024-10-27" and headers[1].total_shipping_fee == "4.75"
    assert headers[2].shipping_city is None and headers[3].total_shipping_fee is None
    lines = payloads.flatten_store_line_items(parsed)
    assert rows(lines.select("order_id", "quantity", "variant_title"), "order_id") == [(1, 2, None), (3, 2, None)]
    assert tuple(quality.reconcile_ids(payloads.flatten_store_orders(parsed), lines, "order_id").first()) == (3, 2)


def test_completeness(spark):
    parsed = docs(spark, "order", order(1, [{"products": [product(1, 11, 12)]}]), order(2, []))
    flat = payloads.flatten_orders(parsed)
    assert tuple(quality.flatten_completeness(parsed, "id", flat, "shipbob_order_id").first()) == (2, 1, False)
    with pytest.raises(ValueError, match="2 documents but 1"):
        quality.require_complete(parsed, "id", flat, "shipbob_order_id")
    whole = parsed.filter("id = 1")
    assert quality.require_complete(whole, "id", flat, "shipbob_order_id") is flat


def test_campaigns_default_to_empty_lists(spark, rows):
    full = {"id": "1", "attributes": {"name": "n", "status": "Sent", "archived": False,
            "audiences": {"included": ["a", "b"], "excluded": ["c"]}, "created_at": "x"}}
    bare = {"id": "2", "attributes": {"name": "m"}}
    flat = payloads.flatten_campaigns(docs(spark, "campaign", full, bare))
    got = rows(flat.select("campaign_id", "included_audience", "excluded_audience"), "campaign_id")
    assert got == [("1", ["a", "b"], ["c"]), ("2", [], [])]


def test_messages_one_row_per_send(spark, rows):
    doc = {"id": "m", "attributes": {"definition": {"channel": "email", "label": "l", "content": {"subject": "s"}},
           "send_times": [{"datetime": "t1"}, {"datetime": "t2"}], "created_at": "c", "updated_at": "u"}}
    flat = payloads.flatten_messages(docs(spark, "message", doc, {"id": "never", "attributes": {"send_times": []}}))
    assert rows(flat.select("message_id", "subject", "cc_email", "send_time"), "send_time") == [
        ("m", "s", None, "t1"), ("m", "s", None, "t2"),
    ]
