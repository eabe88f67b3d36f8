"""Gold: two versioned dimensions and the order-grain fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.deltas import ROWS, changed_groups, counted_groups, merged_groups
from tidemark.operators.ranges import asof_version, versions_in_force
from tidemark.operators.scd2 import FROM, SCD_ID, TO
from tidemark.operators.skew import Cuts

TOTAL = "decimal(20,2)"


def backdate_first_version(versions: DataFrame, key: str, hot_keys: bool = True) -> DataFrame:
    """Add ``valid_from``: the first version of a key starts at ``created_at`` if that is earlier.

    A window over the key is cheapest, but holds all versions of a key in one task. Unless
    the caller knows that no key is that large, the minimum is aggregated map-side and
    matched on (key, start): that pair is all but unique, so a hot key stays spread.
    """
    earlier = F.least(F.coalesce("created_at", FROM), F.col(FROM))
    if not hot_keys:
        first = F.min(FROM).over(Window.partitionBy(key))
        return versions.withColumn("valid_from", F.when(F.col(FROM) == first, earlier).otherwise(F.col(FROM)))
    firsts = versions.groupBy(F.col(key).alias("_key")).agg(F.min(FROM).alias("_first"))
    marked = versions.join(firsts, F.col(key).eqNullSafe(F.col("_key")) & (F.col(FROM) == F.col("_first")), "left")
    start = F.when(F.col("_first").isNotNull(), earlier).otherwise(F.col(FROM))
    return marked.withColumn("valid_from", start).drop("_key", "_first")


# Columns of the dimensions and of the fact, in order.
DIM_CUSTOMERS = (
    "customer_sk customer_id full_name email cpf address city state zip_code created_at updated_at "
    "valid_from valid_to is_current"
).split()
DIM_PRODUCTS = (
    "product_sk product_id sku product_name category_id category_name category_description sale_price unit_cost "
    "current_stock created_at updated_at valid_from valid_to is_current"
).split()
FCT_ORDERS = (
    "order_id customer_id customer_sk order_date order_status order_total shipping_value order_line_count "
    "total_quantity items_subtotal payment_method payment_status payment_amount payment_date updated_at _extracted_at"
).split()


def _dimension(snapshot: DataFrame, key: str, renamed: dict[str, str], columns: list[str], hot_keys: bool) -> DataFrame:
    """Non-empty versions with back-dated start; ``renamed`` maps snapshot columns to the dimension's."""
    lasting = snapshot.filter(F.col(TO).isNull() | (F.col(TO) > F.col(FROM)))
    dated = backdate_first_version(lasting, key, hot_keys).withColumn("is_current", F.col(TO).isNull())
    return dated.withColumnsRenamed({TO: "valid_to", **renamed}).select(columns)


def dim_customers(snapshot: DataFrame, hot_keys: bool = True) -> DataFrame:
    renamed = {SCD_ID: "customer_sk", "id_customer": "customer_id"}
    return _dimension(snapshot, "id_customer", renamed, DIM_CUSTOMERS, hot_keys)


def dim_products(snapshot: DataFrame, hot_keys: bool = True) -> DataFrame:
    renamed = {SCD_ID: "product_sk", "id_product": "product_id", "id_category": "category_id"}
    return _dimension(snapshot, "id_product", renamed, DIM_PRODUCTS, hot_keys)


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("id_order").agg(
        F.count("*").alias("order_line_count"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("subtotal").cast(TOTAL).alias("items_subtotal"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    """Per order; the maxima are independent and may come from different payments."""
    return payments.groupBy("id_order").agg(
        F.max("payment_method").alias("payment_method"),
        F.max("payment_status").alias("payment_status"),
        F.sum("amount").cast(TOTAL).alias("payment_amount"),
        F.max("payment_date").alias("payment_date"),
    )


@dataclass(frozen=True)
class Groups:
    """Counted groups that the totals of an order are kept in: their keys and measures."""

    keys: tuple[str, ...]
    measures: tuple[str, ...]

    def of(self, rows: DataFrame) -> DataFrame:
        return counted_groups(rows.select(*self.keys, *self.measures), self.keys, self.measures)

    def changed(self, old: DataFrame, new: DataFrame) -> DataFrame:
        columns = [*self.keys, *self.measures]
        return changed_groups(old.select(*columns), new.select(*columns), self.keys, self.measures)

    def merged(self, groups: DataFrame, delta: DataFrame) -> DataFrame:
        return merged_groups(groups, delta, self.keys, self.measures)


ITEM_GROUPS = Groups(("id_order",), ("quantity", "subtotal"))
# The maxima are keys, so that the groups of an order are a counted multiset of them.
PAYMENT_GROUPS = Groups(("id_order", "payment_method", "payment_status", "payment_date"), ("amount",))


def _sum_of(measure: str):
    """The sum, or none where no value is left to add up."""
    return F.when(F.col(f"n_{measure}") > 0, F.col(measure))


def kept_item_totals(groups: DataFrame) -> DataFrame:
    """:func:`order_item_totals` from the counted groups of the items."""
    return groups.select(
        "id_order",
        F.col(ROWS).alias("order_line_count"),
        _sum_of("quantity").cast("bigint").alias("total_quantity"),
        _sum_of("subtotal").cast(TOTAL).alias("items_subtotal"),
    )


def kept_payment_totals(groups: DataFrame) -> DataFrame:
    """:func:`payment_totals` from the counted groups of the payments."""
    return groups.groupBy("id_order").agg(
        F.max("payment_method").alias("payment_method"),
        F.max("payment_status").alias("payment_status"),
        F.sum(_sum_of("amount")).cast(TOTAL).alias("payment_amount"),
        F.max("payment_date").alias("payment_date"),
    )


def asof_customer_version(
    orders: DataFrame, customers: DataFrame, cuts: Cuts | None = None, exclusive: bool = False
) -> DataFrame:
    """Orders with the surrogate key of the customer version in force on the order date.

    ``exclusive`` says that versions of a customer are known not to overlap, which makes
    one sorted pass enough; otherwise an order repeats for each version in force.
    """
    versions = customers.select(F.col("customer_id").alias("id_customer"), "customer_sk", "valid_from", "valid_to")
    if exclusive:
        return asof_version(orders, versions, "id_customer", "order_date", "customer_sk", cuts)
    return versions_in_force(orders, versions, "id_customer", "order_date", "customer_sk", cuts)


def fct_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    cuts: Cuts | None = None,
    exclusive: bool = False,
) -> DataFrame:
    """One row per order with its customer version, item totals and payment totals."""
    placed = asof_customer_version(orders, customers, cuts, exclusive)
    return with_totals(placed, order_item_totals(items), payment_totals(payments))


def with_totals(placed: DataFrame, item_totals: DataFrame, payments: DataFrame) -> DataFrame:
    """The fact from orders with their customer version and the totals of both kinds."""
    full = placed.join(item_totals, "id_order", "left").join(payments, "id_order", "left")
    none = {"order_line_count": F.lit(0), "total_quantity": F.lit(0), "items_subtotal": F.lit(0).cast(TOTAL)}
    filled = full.withColumns({c: F.coalesce(c, zero) for c, zero in none.items()})
    renamed = {"id_order": "order_id", "id_customer": "customer_id", "current_status": "order_status", "total_value": "order_total"}
    return filled.withColumnsRenamed(renamed).select(FCT_ORDERS)
