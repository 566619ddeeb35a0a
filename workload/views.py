"""The test tables seen as the declared inventory and order tables.

Only columns a query asks for are derived: ``order_details`` adds a lookup join only when
one of its columns is wanted. Lookups are left joins on unique keys, so leaving one out
never changes the rows. Nothing here subsets a table; filters such as "published" or
"open" are conditions the products themselves are defined on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import INVENTORY_DETAILS, ORDER_DETAILS

AS_OF = dt.date(2001, 7, 1)
RANGE_START = dt.date(2001, 6, 29)
COHORT_START = dt.date(2000, 1, 1)
HISTORY_END = dt.date(2000, 7, 1)
SNAPSHOT_DATES = ("2001-01-31", "2001-06-28", "2001-06-30", "2001-07-02")
RECIPE_DATES = ("2001-06-01", "2001-07-01")
STOCK_DATES = ("2001-06-24", "2001-07-01")
SKU_DATES = ("2001-06-30", "2001-07-01")
NOT_STOCKED = "PROMO"
NEW_KEYS = 10_000_000
# What a header or line carries in place of an e-mail, in turns: addresses to keep and not.
HEADER_EMAILS = ("not-an-email", "o'brien@x.com", "a..b@x.com", "ann@bücher.de", "josé@example.com")
LINE_EMAILS = ("a@b@c", "a!b@x.com", "a@-x.com")
NOT_PUBLISHED = "ECONOMY"


def _text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _days(values: tuple[str, ...]) -> Column:
    return F.explode(F.array(*[F.lit(dt.date.fromisoformat(v)) for v in values]))


def _in_turns(values: tuple[str, ...], key: str) -> Column:
    place = (F.col(key) % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), place)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- order lines ---------------------------------------------------------------

    # Columns of an order line by the table they come from. They are computed on that
    # table, so a customer's e-mail is built once per customer and not once per line.
    # SQL text, because a Column needs a running session.
    _CUSTOMER_COLUMNS = {
        "customer_name": "c_name",
        "customer_email": "concat(lower(translate(c_name, '#', '.')), '@', "
        "lower(c_mktsegment), '.example.com')",
        "customer_address_city": "concat('City ', string(c_nationkey))",
    }
    _PLACE_COLUMNS = {
        "channel_id": "bigint(r_regionkey)",
        "channel_name": "r_name",
        "customer_address_state": "n_name",
        "customer_address_country": "r_name",
    }
    _PART_COLUMNS = {
        "sku": "concat(p_brand, '-', string(p_partkey))",
        "sku_name": "p_name",
        "inventory_name": "p_name",
    }
    _ORDER_COLUMNS = {
        "created_date": "o_orderdate",
        "purchase_date": "o_orderdate",
        "shipbob_order_id": "o_orderkey",
        "order_number": "string(o_orderkey)",
        "order_status": "o_orderstatus",
        "order_type": "o_orderpriority",
        "order_date": "to_date(o_orderdate)",
    }
    _LINE_COLUMNS = {
        "product_id": "l_suppkey * 1000000 + l_partkey",
        "shipping_method": "l_returnflag",
        "inventory_id": "l_partkey",
        "inventory_qty": "bigint(l_quantity)",
    }

    @classmethod
    def email(cls) -> Column:
        return F.expr(cls._CUSTOMER_COLUMNS["customer_email"])

    @staticmethod
    def _derive(df: DataFrame, keys: list[str], columns: dict[str, str], wanted) -> DataFrame:
        return df.select(*keys, *[F.expr(columns[c]).alias(c) for c in wanted if c in columns])

    def _with_places(self, customers: DataFrame) -> DataFrame:
        """Add nation and region columns to rows with c_nationkey."""
        return customers.join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")

    def orders_with_customers(self) -> DataFrame:
        """Every order with its customer and place, and the derived customer columns."""
        customers = self._derive(
            self.table("customer"), ["*"], self._CUSTOMER_COLUMNS, self._CUSTOMER_COLUMNS
        )
        return self._with_places(
            self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        )

    def order_details(self, *columns: str) -> DataFrame:
        """Order lines with the given columns, or all of the declared ones."""
        wanted = columns or (*ORDER_DETAILS.columns, "order_date")

        def needs(*groups: dict[str, str]) -> bool:
            return any(c in group for c in wanted for group in groups)

        orders = self._derive(
            self.table("orders"), ["o_orderkey", "o_custkey"], self._ORDER_COLUMNS, wanted
        )
        lines = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if needs(self._CUSTOMER_COLUMNS, self._PLACE_COLUMNS):
            customers = self._derive(
                self.table("customer"), ["c_custkey", "c_nationkey"], self._CUSTOMER_COLUMNS, wanted
            )
            lines = lines.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        if needs(self._PLACE_COLUMNS):
            # Every lookup side is a bare table, so Spark sizes it right for a broadcast.
            lines = self._with_places(lines)
        if needs(self._PART_COLUMNS):
            parts = self._derive(self.table("part"), ["p_partkey"], self._PART_COLUMNS, wanted)
            lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        late = self._LINE_COLUMNS | self._PLACE_COLUMNS
        return lines.select(*[F.expr(late.get(c, c)).alias(c) for c in wanted])

    def historic_orders(self, *columns: str) -> DataFrame:
        """Lines up to mid 2000; overlaps ``recurring_orders`` by half a year."""
        return self._dated(columns).filter(F.col("order_date") < F.lit(HISTORY_END))

    def recurring_orders(self, *columns: str) -> DataFrame:
        return self._dated(columns).filter(F.col("order_date") >= F.lit(COHORT_START))

    def _dated(self, columns: Iterable[str]) -> DataFrame:
        columns = tuple(columns)
        return self.order_details(*(dict.fromkeys((*columns, "order_date")) if columns else ()))

    # -- snapshots and dimensions -----------------------------------------------------

    def stocked_snapshots(self) -> DataFrame:
        """Snapshots without promotional parts, so that some items sold have no stock row."""
        promotional = self.table("part").filter(F.col("p_type") == NOT_STOCKED).select(F.col("p_partkey").alias("id"))
        return self.inventory_snapshots().join(promotional, "id", "left_anti")

    def inventory_snapshots(self) -> DataFrame:
        """Stock of every part on four days."""
        size = F.col("p_size").cast("bigint")
        on_hand = size * 10 + F.day("partition_date")
        return (
            self.table("part")
            .select("*", _days(SNAPSHOT_DATES).alias("partition_date"))
            .select(
                F.col("p_partkey").alias("id"),
                F.col("p_name").alias("name"),
                (F.col("p_type") == "SMALL").alias("is_digital"),
                (F.col("p_type") == "LARGE").alias("is_case_pick"),
                (F.col("p_type") == "MEDIUM").alias("is_lot"),
                on_hand.alias("total_fulfillable_quantity"),
                (on_hand + size).alias("total_onhand_quantity"),
                size.alias("total_committed_quantity"),
                on_hand.alias("total_sellable_quantity"),
                (size * 2).alias("total_awaiting_quantity"),
                F.lit(0).cast("bigint").alias("total_exception_quantity"),
                F.lit(0).cast("bigint").alias("total_internal_transfer_quantity"),
                (size - 1).alias("total_backordered_quantity"),
                (size > 5).alias("is_active"),
                "partition_date",
            )
        )

    def active_skus(self) -> DataFrame:
        """Variants with stock of published products, on two days."""
        stock = (F.col("p_size") - 10).cast("double")
        return (
            self.table("part")
            .filter((stock > 0) & (F.col("p_type") != NOT_PUBLISHED))
            .select(
                F.concat("p_brand", F.lit("-"), _text("p_partkey")).alias("variant_sku"),
                stock.alias("inventory_quantity"),
                _days(SKU_DATES).alias("partition_date"),
            )
        )

    def _material_count(self) -> Column:
        return self.table("supplier").agg(F.count("*")).scalar()

    def formulas(self) -> DataFrame:
        """Two ingredients per part, spread over all suppliers, on two days."""
        key, count = F.col("p_partkey"), self._material_count()
        base = (F.col("p_size") % 5 + 1).cast("double") / 10
        newest = F.col("partition_date") == F.lit(dt.date.fromisoformat(RECIPE_DATES[-1]))
        return (
            self.table("part")
            .select("*", _days(RECIPE_DATES).alias("partition_date"))
            .select(
                key.cast("double").alias("product_variant_code"),
                F.col("p_name").alias("product_variant_name"),
                F.explode(F.array(key % count, (key * 7 + 3) % count)).alias("material"),
                F.when(newest, base).otherwise(base * 2).alias("quantity_required"),
                "partition_date",
            )
            .select(
                "product_variant_code",
                "product_variant_name",
                F.concat(F.lit("RM-"), _text("material")).alias(
                    "ingredient_variant_code_sku_required"
                ),
                F.concat(F.lit("Material "), _text("material")).alias("ingredient_variant_name"),
                "quantity_required",
                F.lit("kg").alias("unit_of_measure"),
                "partition_date",
            )
        )

    def material_stock(self) -> DataFrame:
        """All suppliers as raw materials, on two days."""
        newest = F.col("partition_date") == F.lit(dt.date.fromisoformat(STOCK_DATES[-1]))
        nation = F.col("s_nationkey")
        return (
            self.table("supplier")
            .select("*", _days(STOCK_DATES).alias("partition_date"))
            .select(
                F.col("s_name").alias("name"),
                F.concat(F.lit("RM-"), _text("s_suppkey")).alias("variant_code_sku"),
                F.lit("kg").alias("units_of_measure"),
                F.when(newest, F.col("s_acctbal")).otherwise(F.col("s_acctbal") + 1).alias("in_stock"),
                F.when(nation < 8, 0.0).when(nation < 16, 100.0).alias("safety_stock"),
                "partition_date",
            )
        )

    def open_mos(self) -> DataFrame:
        """Orders still open, by quarter, as manufacturing orders."""
        material = F.col("o_custkey") % self._material_count()
        priority = F.col("o_orderpriority")
        return (
            self.table("orders")
            .filter(F.col("o_orderstatus") == "O")
            .select(
                _text("o_orderkey").alias("mo"),
                F.concat(F.lit("RM-"), _text(material)).alias("ingredient_variant_code_sku"),
                F.concat(F.lit("Material "), _text(material)).alias("ingredient_variant"),
                # The lowest priority has no unit: its rows lack a grouping key.
                F.when(priority.isin("1-URGENT", "2-HIGH"), "pcs")
                .when(priority != "5-LOW", "case")
                .alias("unit_of_measure"),
                (F.col("o_totalprice") / 100).alias("planned_quantity_of_ingredient"),
                F.trunc(F.col("o_orderdate").cast("date"), "QUARTER").alias("partition_date"),
            )
        )

    def daily_events(self) -> DataFrame:
        return self.table("events").select("*", F.to_date("ts").alias("event_date"))

    def product_metadata(self) -> DataFrame:
        """Every part as a known product."""
        brand = F.col("p_brand")
        return (
            self.table("part")
            .select(
                F.col("p_partkey").alias("inventory_id"),
                F.col("p_name").alias("product_name"),
                _text("p_size").alias("size_variant"),
                brand.alias("sku_variant"),
                F.col("p_type").alias("product_type_variant"),
                (F.col("p_size") > 40).alias("limited_edition_flag"),
                (F.col("p_size") < 5).alias("seasonal_flag"),
                F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
                F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
            )
        )

    def product_changes(self) -> DataFrame:
        """A change for every part: promotional ones under a new key, large ones twice."""
        key = F.col("p_partkey") + F.when(F.col("p_type") == NOT_STOCKED, NEW_KEYS).otherwise(0)
        copies = F.when(F.col("p_size") > 45, F.array(F.lit("a"), F.lit("b"))).otherwise(
            F.array(F.lit("a"))
        )
        return (
            self.table("part")
            .select("*", F.explode(copies).alias("copy"))
            .select(
                key.cast("bigint").alias("inventory_id"),
                F.concat("p_name", F.lit(" "), F.col("copy")).alias("product_name"),
                F.when(F.col("p_type") != "LARGE", _text("p_size")).alias("size_variant"),
                F.lower("p_brand").alias("sku_variant"),
                F.col("p_type").alias("product_type_variant"),
                F.lit(False).alias("limited_edition_flag"),
                F.lit(True).alias("seasonal_flag"),
            )
        )

    # -- nested documents ---------------------------------------------------------------
    # One JSON document per source row; arrays are built per row and have a fixed length.

    @staticmethod
    def _document(df: DataFrame, **parts: Column) -> DataFrame:
        return df.select(
            F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()])).alias("doc")
        )

    @staticmethod
    def _struct(**parts: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    def order_docs(self) -> DataFrame:
        """Every order as a document: two products of two and one items in two shipments.
        Pending orders have no shipments, low-priority orders no channel."""
        s, key, cust = self._struct, F.col("o_orderkey"), F.col("o_custkey")

        def item(item_id: Column, quantity: int) -> Column:
            return s(
                id=item_id,
                name=F.concat(F.lit("Item, "), _text(item_id)),
                quantity=F.lit(quantity).cast("bigint"),
            )

        def product(product_id: Column, *items: Column) -> Column:
            return s(
                id=product_id,
                sku=F.concat(F.lit("SKU-"), _text(product_id)),
                name=F.concat(F.lit("Product "), _text(product_id)),
                inventory_items=F.array(*items),
            )

        shipments = F.array(
            s(products=F.array(product(cust, item(cust, 2), item(key, 1)))),
            s(products=F.array(product(cust + key, item(cust + key, 3)))),
        )
        stamp = F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T23:30:00-04:00"))
        empty = F.filter(shipments, lambda _: F.lit(False))
        return self._document(
            self.orders_with_customers(),
            id=key,
            created_date=stamp,
            purchase_date=stamp,
            order_number=_text(key),
            status=F.col("o_orderstatus"),
            type=F.col("o_orderpriority"),
            shipping_method=F.lit("Standard"),
            channel=F.when(
                F.col("o_orderpriority") != "5-LOW",
                s(id=F.col("r_regionkey").cast("bigint"), name=F.col("r_name")),
            ),
            recipient=s(
                name=F.col("c_name"),
                email=F.col("customer_email"),
                address=s(
                    city=F.col("customer_address_city"),
                    state=F.col("n_name"),
                    country=F.col("r_name"),
                ),
            ),
            shipments=F.when(F.col("o_orderstatus") == "P", empty).otherwise(shipments),
        )

    def product_docs(self) -> DataFrame:
        s, key = self._struct, F.col("p_partkey")
        return self._document(
            self.table("part"),
            id=key,
            sku=F.concat("p_brand", F.lit("-"), _text(key)),
            name=F.col("p_name"),
            channel=s(id=F.col("p_size").cast("bigint"), name=F.col("p_type")),
            fulfillable_inventory_items=F.array(
                s(id=key, name=F.col("p_name"), quantity=F.lit(1).cast("bigint")),
                s(id=key + 1, name=F.lit("insert"), quantity=F.col("p_size").cast("bigint")),
            ),
        )

    def inventory_docs(self) -> DataFrame:
        """Snapshot documents carry more than the table keeps."""
        rows = self.inventory_snapshots()
        lots = F.array(self._struct(lot=F.lit("A"), quantity=F.col("total_onhand_quantity")))
        parts = {c: F.col(c) for c in INVENTORY_DETAILS.columns}
        return self._document(rows, **parts, fulfillable_quantity_by_lot=lots)

    def store_product_docs(self) -> DataFrame:
        """Parts as storefront products. Each listing page is delivered twice."""
        s, key = self._struct, F.col("p_partkey")
        pages = self.table("part").select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("page"))
        return self._document(
            pages,
            id=key,
            title=F.col("p_name"),
            published_at=F.when(
                F.col("p_type") != NOT_PUBLISHED, F.lit("2001-03-04T05:06:07-04:00")
            ),
            variants=F.array(
                s(
                    id=key * 10,
                    title=F.lit("small"),
                    sku=F.concat("p_brand", F.lit("-"), _text(key)),
                    inventory_quantity=(F.col("p_size") - 10).cast("double"),
                ),
                s(
                    id=key * 10 + 1,
                    title=F.lit("large"),
                    sku=F.concat(F.lit("L-"), _text(key)),
                    inventory_quantity=(25 - F.col("p_size")).cast("double"),
                ),
            ),
        )

    def store_order_docs(self) -> DataFrame:
        """Every order as a storefront document. Urgent orders lack an address, pending
        ones have no lines."""
        s, key, total = self._struct, F.col("o_orderkey"), F.col("o_totalprice")

        def line(kind: str, quantity: Column, price: Column) -> Column:
            return s(
                price=_text(price),
                quantity=quantity.cast("bigint"),
                sku=F.concat(F.lit(f"{kind}-"), _text("o_custkey")),
                title=F.lit(f"{kind} item"),
                variant_title=F.when(F.col("o_orderstatus") == "F", F.lit("default")),
                name=F.concat(F.lit(f"{kind} of order "), _text(key)),
            )

        lines = F.array(line("main", F.lit(2), total), line("gift", F.lit(1), F.lit(0.5)))
        empty = F.filter(lines, lambda _: F.lit(False))
        return self._document(
            self.orders_with_customers(),
            order_number=key,
            created_at=F.concat(
                F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T21:00:00-04:00")
            ),
            email=F.col("customer_email"),
            subtotal_price=_text(total),
            total_line_items_price=_text(total),
            total_tax=_text(F.lit(1.25)),
            total_discounts=_text(F.lit(0.0)),
            total_shipping_price_set=F.when(
                F.col("o_orderpriority") != "5-LOW", s(shop_money=s(amount=_text(F.lit(4.75))))
            ),
            total_price=_text(total),
            shipping_address=F.when(
                F.col("o_orderpriority") != "1-URGENT",
                s(
                    address1=F.concat(_text("o_custkey"), F.lit(" Main St")),
                    city=F.col("customer_address_city"),
                    province=F.col("n_name"),
                    country=F.col("r_name"),
                ),
            ),
            line_items=F.when(F.col("o_orderstatus") == "P", empty).otherwise(lines),
        )

    def campaign_docs(self) -> DataFrame:
        """Every customer as a campaign; some segments have no exclusion list."""
        s, segment = self._struct, F.col("c_mktsegment")
        stamp = F.lit("2001-01-01T00:00:00+00:00")
        return self._document(
            self.table("customer"),
            id=_text("c_custkey"),
            attributes=s(
                name=F.col("c_name"),
                status=F.when(F.col("c_acctbal") < 0, "Draft").otherwise("Sent"),
                archived=F.col("c_acctbal") > 5000,
                audiences=s(
                    included=F.array(segment, F.lower(segment)),
                    excluded=F.when(segment != "BUILDING", F.array(_text("c_nationkey"))),
                ),
                created_at=stamp,
                scheduled_at=F.when(F.col("c_acctbal") >= 0, stamp),
                send_time=stamp,
                updated_at=stamp,
            ),
        )

    def message_docs(self) -> DataFrame:
        """Every event as a message, sent twice unless it is an error (never sent)."""
        s, stamp = self._struct, F.col("ts").cast("string")
        times = F.array(
            s(datetime=stamp), s(datetime=F.concat(F.substring(stamp, 1, 10), F.lit("T12:00:00")))
        )
        empty = F.filter(times, lambda _: F.lit(False))
        return self._document(
            self.table("events"),
            id=_text("event_id"),
            attributes=s(
                definition=s(
                    channel=F.lit("email"),
                    label=F.col("event_type"),
                    content=s(
                        subject=F.concat(F.lit("Hello "), _text("user_id")),
                        preview_text=F.when(F.col("event_type") == "view", F.lit("preview")),
                        from_email=F.lit("shop@example.com"),
                        from_label=F.lit("Shop"),
                        reply_to_email=F.lit("reply@example.com"),
                        cc_email=F.lit(None).cast("string"),
                        bcc_email=F.lit(None).cast("string"),
                    ),
                ),
                send_times=F.when(F.col("event_type") == "error", empty).otherwise(times),
                created_at=F.substring(stamp, 1, 10),
                updated_at=F.substring(stamp, 1, 10),
            ),
        )

    # -- rows that need validation ---------------------------------------------------------

    def raw_store_orders(self) -> DataFrame:
        """Storefront headers as text, with the faults real exports contain."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        email = F.col("customer_email")
        total = _text("o_totalprice")
        stamp = F.concat(
            F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T23:30:00-04:00")
        )
        return self.orders_with_customers().select(
            _text("o_orderkey").alias("order_id"),
            F.when(priority == "1-URGENT", F.lit(""))
            .when(priority == "2-HIGH", _in_turns(HEADER_EMAILS, "o_orderkey"))
            .when(priority != "3-MEDIUM", email)
            .alias("email"),
            F.when((status == "O") & (priority == "5-LOW"), F.lit("not a time"))
            .otherwise(stamp)
            .alias("created_at"),
            F.concat(_text("o_custkey"), F.lit(", Main St")).alias("shipping_address"),
            F.col("n_name").alias("shipping_city"),
            F.col("n_name").alias("shipping_province"),
            F.col("r_name").alias("shipping_country"),
            total.alias("subtotal_price"),
            F.when((status == "F") & (priority == "5-LOW"), F.lit("-1"))
            .otherwise(total)
            .alias("total_line_items_price"),
            F.lit("0.5").alias("total_tax"),
            F.when((status == "P") & (priority == "1-URGENT"), F.lit("x"))
            .otherwise(F.lit("0"))
            .alias("total_discounts"),
            F.when(
                (status != "P") | ~priority.isin("1-URGENT", "2-HIGH"), F.lit("4.75")
            ).alias("total_shipping_fee"),
            total.alias("total_price"),
            F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("order_date"),
            status.alias("internal_note"),
        )

    def raw_store_lines(self) -> DataFrame:
        """Storefront lines as text, with delimiters, blanks and zone offsets."""
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            F.when(flag == "R", F.lit("")).when(flag == "N", _in_turns(LINE_EMAILS, "l_orderkey"))
            .otherwise(F.concat(F.lit("buyer"), _text("l_suppkey"), F.lit("@example.com")))
            .alias("email"),
            F.concat(
                F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit("T23:30:00-04:00")
            ).alias("created_at"),
            F.col("l_linenumber").alias("line_number"),
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("SKU,"), _text("l_partkey")))
            .when(flag == "A", F.lit(""))
            .alias("sku"),
            F.concat(F.lit('Say "hi",\n'), _text("l_partkey")).alias("title"),
        )
