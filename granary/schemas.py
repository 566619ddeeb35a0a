"""One declaration per table: column order, types, required flags and cleaning rules.

Table schemas, DDL and row validation all derive from these declarations. Column order
is part of the contract because headered text tables are read back by position.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import types as pytypes
import typing

from pyspark.sql import types as T

_SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclasses.dataclass(frozen=True)
class Field:
    """``clean`` names steps of ``operators.quality.CLEANERS``, applied in order."""

    name: str
    type: str
    required: bool = True
    minimum: float | None = None
    clean: tuple[str, ...] = ()
    comment: str = ""

    def struct_field(self) -> T.StructField:
        meta = {"comment": self.comment} if self.comment else {}
        return T.StructField(self.name, _SPARK_TYPES[self.type], True, meta)


@dataclasses.dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple[Field, ...]
    partition: tuple[Field, ...] = ()
    comment: str = ""

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def partition_columns(self) -> list[str]:
        return [f.name for f in self.partition]

    def struct(self, with_partition: bool = False) -> T.StructType:
        fields = self.fields + (self.partition if with_partition else ())
        return T.StructType([f.struct_field() for f in fields])


def _fields(spec: str, **shared) -> tuple[Field, ...]:
    """``"a bigint, b string?"`` -> fields; ``?`` marks an optional column."""
    out = []
    for part in spec.split(","):
        name, kind = part.split()
        out.append(Field(name, kind.rstrip("?"), required=not kind.endswith("?"), **shared))
    return tuple(out)


def _refine(fields: tuple[Field, ...], **changes: dict) -> tuple[Field, ...]:
    return tuple(dataclasses.replace(f, **changes.get(f.name, {})) for f in fields)


def _clean_strings(fields: tuple[Field, ...], *steps: str) -> tuple[Field, ...]:
    return tuple(
        dataclasses.replace(f, clean=steps + f.clean) if f.type == "string" else f for f in fields
    )


BY_DAY = (Field("partition_date", "date"),)
BY_ORDER_DATE = (Field("order_date", "date"),)
BY_YMD = _fields("year string, month string, day string")

ORDER_DETAILS = Entity(
    "order_details",
    _clean_strings(
        _fields(
            "created_date timestamp_ntz, purchase_date timestamp_ntz, shipbob_order_id bigint,"
            "order_number string, order_status string, order_type string, channel_id bigint,"
            "channel_name string, product_id bigint, sku string, shipping_method string,"
            "customer_name string?, customer_email string?, customer_address_city string?,"
            "customer_address_state string?, customer_address_country string?, sku_name string,"
            "inventory_id bigint, inventory_name string, inventory_qty bigint"
        ),
        "commas",
    ),
    BY_ORDER_DATE,
    "One row per order, product and inventory item",
)

INVENTORY_DETAILS = Entity(
    "inventory_details",
    _fields(
        "id bigint, name string, is_digital boolean, is_case_pick boolean, is_lot boolean,"
        "total_fulfillable_quantity bigint, total_onhand_quantity bigint,"
        "total_committed_quantity bigint, total_sellable_quantity bigint,"
        "total_awaiting_quantity bigint, total_exception_quantity bigint,"
        "total_internal_transfer_quantity bigint, total_backordered_quantity bigint,"
        "is_active boolean"
    ),
    BY_DAY,
    "Daily stock snapshot per inventory item",
)

RUN_RATE = Entity(
    "inventory_run_rate",
    _fields(
        "inventory_id bigint, run_rate double, name string, total_fulfillable_quantity bigint,"
        "est_stock_days_on_hand double, estimated_stockout_date date, restock_point bigint"
    ),
    BY_DAY,
    "Daily run rate and stock cover per inventory item",
)

ACTIVE_VARIANT_SKUS = Entity(
    "active_variant_skus",
    _refine(
        _fields(
            "product_id bigint, product_title string, variant_id bigint, variant_title string,"
            "variant_sku string, inventory_quantity double, published_at timestamp_ntz"
        ),
        inventory_quantity={"minimum": 0},
    ),
    BY_DAY,
    "Variants on sale with stock",
)

_NULLABLE_TEXT = {"clean": ("nan",)}

MATERIAL_INVENTORY = Entity(
    "material_inventory",
    _refine(
        _fields(
            "name string, variant_code_sku string?, category string?, default_supplier string?,"
            "units_of_measure string, average_cost double, value_in_stock double, in_stock double,"
            "expected double, committed double, safety_stock double, calculated_stock double,"
            "location string"
        ),
        variant_code_sku=_NULLABLE_TEXT,
        category=_NULLABLE_TEXT,
        default_supplier=_NULLABLE_TEXT,
    ),
    BY_DAY,
    "Daily raw-material stock snapshot",
)

FORMULAS = Entity(
    "formulas",
    tuple(
        dataclasses.replace(f, clean=("nan",))
        for f in _fields(
            "product_variant_code double?, product_variant_name string?,"
            "product_supplier_item_code string?, product_internal_barcode string?,"
            "product_registered_barcode string?, ingredient_variant_code_sku_required string,"
            "ingredient_variant_name string?, ingredient_supplier_item_code string?,"
            "ingredient_internal_barcode string?, ingredient_registered_barcode string?,"
            "notes string?, quantity_required double, unit_of_measure string?,"
            "current_stock_price double"
        )
    ),
    BY_DAY,
    "Bill of materials: one row per product and ingredient",
)

MANUFACTURING_ORDERS = Entity(
    "open_manufacturing_orders",
    _refine(
        tuple(
            dataclasses.replace(f, clean=("nan",))
            for f in _fields(
                "mo string, created_date date, done_date date?, production_status string,"
                "product_variant_code_sku double, product_variant string,"
                "planned_quantity_of_product double, actual_quantity_of_product double?,"
                "unit_of_measure string, ingredient_variant_code_sku string,"
                "ingredient_variant string, ingredient_notes string?,"
                "planned_quantity_of_ingredient double, actual_quantity_of_ingredient double?,"
                "ingredient_unit_of_measure string, ingredient_cost double,"
                "ingredient_status string"
            )
        ),
        created_date={"clean": ("nan", "blank")},
        done_date={"clean": ("nan", "blank")},
    ),
    BY_DAY,
    "Open manufacturing orders, one row per order and ingredient",
)

RAW_MATERIAL_RUN_RATE = Entity(
    "raw_material_run_rate",
    _fields(
        "katana_ingredient_sku string, katana_ingredient_name string,"
        "katana_unit_of_measure string, daily_run_rate double, inventory_on_hand double,"
        "inventory_as_of date, days_on_hand double?, reorder_point double?"
    ),
    BY_DAY,
    "Daily demand, cover and reorder point per raw material",
)

RAW_MATERIAL_STATUS = Entity(
    "raw_material_status",
    _fields(
        "name string, units_of_measure string, in_stock double, in_stock_as_of date,"
        "planned_qty double, planned_qty_as_of date, inventory_remaining double,"
        "in_stock_percentage double, needs_replenished boolean"
    ),
    BY_DAY,
    "Coverage of open manufacturing orders by raw-material stock",
)

_MONEY = {"minimum": 0}
_EMAIL = {"clean": ("commas", "email")}

STORE_ORDERS = Entity(
    "store_orders",
    _refine(
        _clean_strings(
            _fields(
                "order_id bigint, email string, created_at timestamp_ntz, shipping_address string?,"
                "shipping_city string?, shipping_province string?, shipping_country string?,"
                "subtotal_price double, total_line_items_price double, total_tax double,"
                "total_discounts double, total_shipping_fee double, total_price double,"
                "order_date timestamp_ntz"
            ),
            "commas",
            "nan",
        ),
        email=_EMAIL,
        subtotal_price=_MONEY,
        total_line_items_price=_MONEY,
        total_tax=_MONEY,
        total_discounts=_MONEY,
        total_shipping_fee=_MONEY,
        total_price=_MONEY,
    ),
    BY_YMD,
    "Storefront order headers",
)

STORE_LINE_ITEMS = Entity(
    "store_line_items",
    _refine(
        _clean_strings(
            _fields(
                "order_id bigint, email string, created_at timestamp_ntz,"
                "order_date timestamp_ntz, price double, quantity bigint, sku string,"
                "title string, variant_title string?, line_item_name string"
            ),
            "commas",
        ),
        email=_EMAIL,
        price=_MONEY,
        quantity=_MONEY,
        sku={"clean": ("commas", "nan", "sku")},
    ),
    BY_YMD,
    "Storefront order lines",
)

PRODUCT_METADATA = Entity(
    "product_metadata",
    _fields(
        "inventory_id bigint, product_name string, size_variant string?, sku_variant string?,"
        "product_type_variant string?, limited_edition_flag boolean?, seasonal_flag boolean?,"
        "created_at timestamp_ntz?, updated_at timestamp_ntz?"
    ),
    comment="Hand-kept product attributes, one row per inventory item",
)

PRODUCT_DIMENSION = dataclasses.replace(PRODUCT_METADATA, partition=(Field("bucket", "bigint"),))

DAILY_ORDER_COUNT = Entity(
    "daily_order_cnt_by_channel",
    (
        Field("channel_id", "string", comment="Sales channel id"),
        Field("channel_name", "string", comment="Sales channel name"),
        Field("order_cnt", "bigint", comment="Distinct orders placed on the day"),
    ),
    BY_ORDER_DATE,
    "Distinct orders per sales channel and day",
)

RETENTION = Entity(
    "retention_by_cohort",
    _fields(
        "cohort_month date?, total_customers bigint, retained_30d_count bigint,"
        "retained_30d_pct double, retained_60d_count bigint, retained_60d_pct double,"
        "retained_90d_count bigint, retained_90d_pct double"
    ),
    (Field("report_date", "date"),),
    "Share of each monthly cohort that ordered again within 30, 60 and 90 days",
)

BY_STATE_DATE = (Field("state_date", "date"),)

CUSTOMER_DAYS = Entity(
    "customer_days",
    _fields("email string, first_day date?, second_day date?"),
    BY_STATE_DATE,
    "Earliest two order days of each customer from the first cohort on, as known on a day",
)

OPEN_HISTORY = Entity(
    "open_history",
    _fields("order_number string, email string, purchase_day date"),
    BY_STATE_DATE,
    "History orders that no recurring order has replaced by a day",
)

OBFUSCATED_LINE_ITEMS = Entity(
    "all_line_item_obfuscated",
    _fields(
        "customer_hash string, shipbob_order_id_hash string, customer_email_masked string?,"
        "customer_name_masked string?, customer_address_state string?,"
        "customer_address_country string?, order_status string, order_type string,"
        "channel_id string, channel_name string, product_id string, sku string,"
        "shipping_method string, sku_name string, inventory_id string, inventory_name string,"
        "inventory_qty string, order_month date, snapshot_date date, created_date date"
    ),
    comment="All order lines without personal data",
)

RUN_RATE_MART = Entity(
    "inventory_run_rate_mart",
    (
        Field("inventory_id", "bigint", comment="Inventory item id"),
        Field("name", "string", comment="Inventory item name"),
        Field("total_fulfillable_quantity", "bigint", comment="Units that can be shipped"),
        Field("est_daily_run_rate", "double", comment="Estimated units sold per day"),
        Field("est_stock_days_on_hand", "double", comment="Estimated days of stock, at most 365"),
        Field("estimated_stockout_date", "date", comment="Estimated first day without stock"),
        Field("restock_point", "bigint", comment="Stock level at which to reorder"),
    ),
    BY_DAY,
    "Newest run rate per inventory item",
)

ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        ORDER_DETAILS,
        INVENTORY_DETAILS,
        RUN_RATE,
        ACTIVE_VARIANT_SKUS,
        MATERIAL_INVENTORY,
        FORMULAS,
        MANUFACTURING_ORDERS,
        RAW_MATERIAL_RUN_RATE,
        RAW_MATERIAL_STATUS,
        STORE_ORDERS,
        STORE_LINE_ITEMS,
        PRODUCT_METADATA,
        DAILY_ORDER_COUNT,
        RETENTION,
        CUSTOMER_DAYS,
        OPEN_HISTORY,
        OBFUSCATED_LINE_ITEMS,
        RUN_RATE_MART,
    )
}

_PYTHON_TYPES = {
    int: "bigint",
    float: "double",
    str: "string",
    bool: "boolean",
    dt.datetime: "timestamp_ntz",
    dt.date: "date",
}


def struct_from_annotations(model: type) -> T.StructType:
    """Table schema of an annotated Python class; ``Optional`` columns are nullable."""
    fields = []
    for name, hint in typing.get_type_hints(model).items():
        nullable = False
        if typing.get_origin(hint) in (typing.Union, pytypes.UnionType):
            members = [a for a in typing.get_args(hint) if a is not type(None)]
            nullable = len(members) < len(typing.get_args(hint))
            hint = members[0] if len(members) == 1 else hint
        if hint not in _PYTHON_TYPES:
            raise ValueError(f"unsupported type for column {name}: {hint}")
        fields.append(T.StructField(name, _SPARK_TYPES[_PYTHON_TYPES[hint]], nullable))
    return T.StructType(fields)
