"""Corrections and totals on the source tables, as batch jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import money

ORDER_TOTAL = "decimal(22,2)"


def backfill_created_at(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers created no later than their first order; nothing else changes."""
    first = orders.groupBy("id_customer").agg(F.min("order_date").alias("_first"))
    joined = customers.join(first, "id_customer", "left")
    lowered = F.when(F.col("created_at") > F.col("_first"), F.col("_first")).otherwise(F.col("created_at"))
    return joined.withColumn("created_at", lowered).select(*customers.columns)


def refresh_descriptions(categories: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Categories whose name starts with a listed prefix get the prefix's description.

    The pairs are a short literal list, so this is a projection without any join. Where
    several prefixes fit, the last one listed wins, as if applied one after another.
    """
    fitting = [F.when(F.col("category_name").startswith(p), F.lit(d)) for p, d in reversed(list(pairs))]
    return categories.withColumn("description", F.coalesce(*fitting, F.col("description")))


def _with_total(orders: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Orders with shipping, as money, plus quantity times unit price over their items."""
    sums = items.groupBy("id_order").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("_items"))
    total = money(F.col("shipping_value")) + F.coalesce("_items", F.lit(0))
    return orders.join(sums, "id_order", "left").withColumn(name, total.cast(ORDER_TOTAL)).drop("_items")


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per order: shipping plus quantity times unit price over its items."""
    return _with_total(orders, items, "order_total").select("id_order", "order_total")


def check_order_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose stored total is not the computed one (NULL counts as different)."""
    stored = F.col("total_value").cast(ORDER_TOTAL).alias("stored_total")
    compared = _with_total(orders, items, "computed_total").select("id_order", stored, "computed_total")
    return compared.filter(~F.col("stored_total").eqNullSafe(F.col("computed_total")))
