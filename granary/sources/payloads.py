"""Nested documents -> flat rows.

Every flattener takes documents already parsed to the schema given here (see
``read_documents`` and ``parse_documents``) and is a plain select/explode: rows are
produced where the document is read, nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import dates
from granary.schemas import ACTIVE_VARIANT_SKUS, INVENTORY_DETAILS, ORDER_DETAILS

ORDER_DOC = """
    id BIGINT, created_date STRING, purchase_date STRING, order_number STRING, status STRING,
    type STRING, shipping_method STRING,
    channel STRUCT<id: BIGINT, name: STRING>,
    recipient STRUCT<name: STRING, email: STRING,
                     address: STRUCT<city: STRING, state: STRING, country: STRING>>,
    shipments ARRAY<STRUCT<products: ARRAY<STRUCT<id: BIGINT, sku: STRING, name: STRING,
        inventory_items: ARRAY<STRUCT<id: BIGINT, name: STRING, quantity: BIGINT>>>>>>
"""

PRODUCT_DOC = """
    id BIGINT, sku STRING, name STRING, channel STRUCT<id: BIGINT, name: STRING>,
    fulfillable_inventory_items ARRAY<STRUCT<id: BIGINT, name: STRING, quantity: BIGINT>>
"""

STORE_PRODUCT_DOC = """
    id BIGINT, title STRING, published_at STRING,
    variants ARRAY<STRUCT<id: BIGINT, title: STRING, sku: STRING, inventory_quantity: DOUBLE>>
"""

STORE_ORDER_DOC = """
    order_number BIGINT, created_at STRING, email STRING, subtotal_price STRING,
    total_line_items_price STRING, total_tax STRING, total_discounts STRING,
    total_shipping_price_set STRUCT<shop_money: STRUCT<amount: STRING>>,
    total_price STRING,
    shipping_address STRUCT<address1: STRING, city: STRING, province: STRING, country: STRING>,
    line_items ARRAY<STRUCT<price: STRING, quantity: BIGINT, sku: STRING, title: STRING,
                            variant_title: STRING, name: STRING>>
"""

CAMPAIGN_DOC = """
    id STRING, attributes STRUCT<name: STRING, status: STRING, archived: BOOLEAN,
        audiences: STRUCT<included: ARRAY<STRING>, excluded: ARRAY<STRING>>,
        created_at: STRING, scheduled_at: STRING, send_time: STRING, updated_at: STRING>
"""

MESSAGE_DOC = """
    id STRING, attributes STRUCT<
        definition: STRUCT<channel: STRING, label: STRING,
            content: STRUCT<subject: STRING, preview_text: STRING, from_email: STRING,
                from_label: STRING, reply_to_email: STRING, cc_email: STRING, bcc_email: STRING>>,
        send_times: ARRAY<STRUCT<datetime: STRING>>, created_at: STRING, updated_at: STRING>
"""

# Documents carry more than the snapshot columns; reading to this schema drops the rest.
INVENTORY_DOC = ", ".join(f"{f.name} {f.type}" for f in INVENTORY_DETAILS.fields)

DOCUMENT_SCHEMAS = {
    "inventory": INVENTORY_DOC,
    "order": ORDER_DOC,
    "product": PRODUCT_DOC,
    "store_product": STORE_PRODUCT_DOC,
    "store_order": STORE_ORDER_DOC,
    "campaign": CAMPAIGN_DOC,
    "message": MESSAGE_DOC,
}


def _ddl(kind: str) -> str:
    return " ".join(DOCUMENT_SCHEMAS[kind].split())


def read_documents(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Landed JSON-lines files of one document kind; malformed lines fail the job."""
    return spark.read.schema(_ddl(kind)).option("mode", "FAILFAST").json(path)


def parse_documents(df: DataFrame, kind: str, column: str = "doc") -> DataFrame:
    """JSON text held in a column -> document columns."""
    return df.select(F.from_json(column, _ddl(kind), {"mode": "FAILFAST"}).alias("d")).select("d.*")


def _elements(docs: DataFrame, array: str, name: str) -> DataFrame:
    """One row per array element; documents without elements vanish.

    ``explode`` would let Spark derive a test of the array's size and push it below the
    parse, where it parses the text a second time. A filter on the element cannot move.
    """
    return docs.select("*", F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def flatten_orders(docs: DataFrame) -> DataFrame:
    """One row per order x product x inventory item; an order without items vanishes.

    A missing channel gives null channel columns. Timestamps keep their wall clock.
    """
    shipments = _elements(docs, "shipments", "shipment")
    products = _elements(shipments, "shipment.products", "product")
    items = _elements(products, "product.inventory_items", "item")
    flat = {
        "created_date": dates.wall_clock(F.col("created_date")),
        "purchase_date": dates.wall_clock(F.col("purchase_date")),
        "shipbob_order_id": F.col("id"),
        "order_number": F.col("order_number"),
        "order_status": F.col("status"),
        "order_type": F.col("type"),
        "shipping_method": F.col("shipping_method"),
        "channel_id": F.col("channel.id"),
        "channel_name": F.col("channel.name"),
        "customer_name": F.col("recipient.name"),
        "customer_email": F.col("recipient.email"),
        "customer_address_city": F.col("recipient.address.city"),
        "customer_address_state": F.col("recipient.address.state"),
        "customer_address_country": F.col("recipient.address.country"),
        "product_id": F.col("product.id"),
        "sku": F.col("product.sku"),
        "sku_name": F.col("product.name"),
        "inventory_id": F.col("item.id"),
        "inventory_qty": F.col("item.quantity"),
        "inventory_name": F.col("item.name"),
    }
    return items.select(*[flat[name].alias(name) for name in ORDER_DETAILS.columns])


def flatten_products(docs: DataFrame) -> DataFrame:
    """One row per product x inventory item it is fulfilled from."""
    return _elements(docs, "fulfillable_inventory_items", "item").select(
        F.col("id").alias("product_id"),
        "sku",
        F.col("name").alias("sku_name"),
        F.col("channel.id").alias("channel_id"),
        F.col("channel.name").alias("channel_name"),
        F.col("item.id").alias("inventory_id"),
        F.col("item.name").alias("inventory_name"),
        F.col("item.quantity").alias("inventory_qty"),
    )


def project_inventory(docs: DataFrame) -> DataFrame:
    """The snapshot columns of an inventory document; nested extras are dropped."""
    return docs.select(*INVENTORY_DETAILS.columns)


def active_variants(docs: DataFrame) -> DataFrame:
    """Variants with stock whose product is published.

    The listing delivers a product on more than one page, so a variant is kept once: the copy
    published last, then the one with most stock, then the greatest product and texts.
    Variants without id are told apart by all their columns.
    """
    # One condition on the document and the element: it cannot move below the parse.
    stock = F.when(F.col("published_at") != "", F.col("variant.inventory_quantity"))
    on_sale = _elements(docs, "variants", "variant").filter(stock > 0)
    flat = {
        "product_id": F.col("id"),
        "product_title": F.col("title"),
        "variant_id": F.col("variant.id"),
        "variant_title": F.col("variant.title"),
        "variant_sku": F.col("variant.sku"),
        "inventory_quantity": F.col("variant.inventory_quantity"),
        "published_at": dates.wall_clock(F.col("published_at")),
    }
    names = ACTIVE_VARIANT_SKUS.columns
    rest = [n for n in names if n not in ("published_at", "inventory_quantity")]
    order = F.struct("published_at", "inventory_quantity", *rest)
    unknown = F.when(F.col("variant_id").isNull(), F.struct(*names)).alias("unknown")
    return (
        on_sale.select(*[flat[name].alias(name) for name in names])
        .groupBy("variant_id", unknown)
        .agg(F.max(order).alias("copy"))
        .select(*[F.col(f"copy.{n}").alias(n) for n in names])
    )


def _store_header() -> list[Column]:
    return [
        F.col("order_number").alias("order_id"),
        F.col("email"),
        F.col("created_at"),
        F.substring("created_at", 1, 10).alias("order_date"),
    ]


def flatten_store_orders(docs: DataFrame) -> DataFrame:
    """Order headers; a missing address or shipping price gives nulls."""
    return docs.select(
        *_store_header(),
        "subtotal_price",
        "total_line_items_price",
        "total_tax",
        "total_discounts",
        F.col("total_shipping_price_set.shop_money.amount").alias("total_shipping_fee"),
        "total_price",
        F.col("shipping_address.address1").alias("shipping_address"),
        F.col("shipping_address.city").alias("shipping_city"),
        F.col("shipping_address.province").alias("shipping_province"),
        F.col("shipping_address.country").alias("shipping_country"),
    )


def flatten_store_line_items(docs: DataFrame) -> DataFrame:
    """Order lines with the header fields carried down."""
    return _elements(docs, "line_items", "line").select(
        *_store_header(),
        F.col("line.price").alias("price"),
        F.col("line.quantity").alias("quantity"),
        F.col("line.sku").alias("sku"),
        F.col("line.title").alias("title"),
        F.col("line.variant_title").alias("variant_title"),
        F.col("line.name").alias("line_item_name"),
    )


def _list_or_empty(path: str) -> Column:
    return F.coalesce(F.col(path), F.array().cast("array<string>"))


def flatten_campaigns(docs: DataFrame) -> DataFrame:
    """One row per campaign; missing audience lists become empty lists."""
    return docs.select(
        F.col("id").alias("campaign_id"),
        "attributes.name",
        "attributes.status",
        "attributes.archived",
        _list_or_empty("attributes.audiences.included").alias("included_audience"),
        _list_or_empty("attributes.audiences.excluded").alias("excluded_audience"),
        "attributes.created_at",
        "attributes.scheduled_at",
        "attributes.send_time",
        "attributes.updated_at",
    )


def flatten_messages(docs: DataFrame) -> DataFrame:
    """One row per time a message was sent."""
    return _elements(docs, "attributes.send_times", "sent").select(
        F.col("id").alias("message_id"),
        "attributes.definition.channel",
        "attributes.definition.label",
        "attributes.definition.content.*",
        F.col("sent.datetime").alias("send_time"),
        "attributes.created_at",
        "attributes.updated_at",
    )
