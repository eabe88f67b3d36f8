"""Silver staging: one cleaned row per raw row, with the extraction stamp carried along."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_lower, clean_upper, money


# Columns of the staged tables, in order.
COLUMNS = {
    "customers": "id_customer full_name email cpf address city state zip_code created_at updated_at _extracted_at".split(),
    "categories": "id_category category_name description _extracted_at".split(),
    "products": (
        "id_product sku product_name id_category sale_price unit_cost current_stock created_at updated_at _extracted_at"
    ).split(),
    "orders": "id_order id_customer order_date total_value shipping_value current_status updated_at _extracted_at".split(),
    "order_items": "id_item id_order id_product quantity unit_price subtotal _extracted_at".split(),
    "payments": "id_payment id_order payment_method payment_status amount payment_date _extracted_at".split(),
}


def stg_customers(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns(
        {"full_name": F.trim("full_name"), "email": clean_lower("email"), "state": F.upper("state")}
    )
    return cleaned.select(COLUMNS["customers"])


def stg_categories(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns({c: F.trim(c) for c in ("category_name", "description")})
    return cleaned.select(COLUMNS["categories"])


def stg_products(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns(
        {
            "sku": clean_upper("sku"),
            "product_name": F.trim("product_name"),
            **{c: money(F.col(c)) for c in ("sale_price", "unit_cost")},
        }
    )
    return cleaned.select(COLUMNS["products"])


def stg_orders(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns(
        {
            **{c: money(F.col(c)) for c in ("total_value", "shipping_value")},
            "current_status": clean_upper("current_status"),
        }
    )
    return cleaned.select(COLUMNS["orders"])


def stg_order_items(raw: DataFrame) -> DataFrame:
    """The subtotal is recomputed from the unrounded price; a source subtotal is ignored."""
    subtotal = money(F.col("quantity") * F.col("unit_price"))
    return raw.withColumns({"subtotal": subtotal, "unit_price": money(F.col("unit_price"))}).select(COLUMNS["order_items"])


def stg_payments(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns(
        {**{c: clean_upper(c) for c in ("payment_method", "payment_status")}, "amount": money(F.col("amount"))}
    )
    return cleaned.select(COLUMNS["payments"])


STAGING: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "customers": stg_customers,
    "categories": stg_categories,
    "products": stg_products,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "payments": stg_payments,
}


def create_views(raw: Mapping[str, DataFrame], prefix: str = "stg_") -> dict[str, DataFrame]:
    """Build every staging frame and register it as a temporary view."""
    staged = {}
    for name, build in STAGING.items():
        staged[name] = build(raw[name])
        staged[name].createOrReplaceTempView(f"{prefix}{name}")
    return staged
