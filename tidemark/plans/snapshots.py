"""The two tracked dimensions: what is watched, and how their source is put together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scd2 import scd2_apply

# A new version opens when one of these columns differs.
CUSTOMER_CHECKS = ("full_name", "email", "cpf", "address", "city", "state", "zip_code", "created_at", "updated_at")
PRODUCT_CHECKS = (
    "sku",
    "product_name",
    "id_category",
    "sale_price",
    "unit_cost",
    "current_stock",
    "category_name",
    "category_description",
    "created_at",
    "updated_at",
)


def products_with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with name and description of their category, NULL for an unknown one.

    Categories are few in practice, but nothing bounds them: Spark broadcasts them when
    their measured size allows it and otherwise joins by shuffle, splitting a category
    that holds too many products.
    """
    named = categories.select("id_category", "category_name", F.col("description").alias("category_description"))
    joined = products.join(named, "id_category", "left")
    return joined.select(*products.columns, "category_name", "category_description")


def snapshot_customers(history: DataFrame, customers: DataFrame, run_ts) -> DataFrame:
    return scd2_apply(history, customers, "id_customer", CUSTOMER_CHECKS, run_ts)


def snapshot_products(history: DataFrame, products: DataFrame, categories: DataFrame, run_ts) -> DataFrame:
    source = products_with_category(products, categories)
    return scd2_apply(history, source, "id_product", PRODUCT_CHECKS, run_ts)
