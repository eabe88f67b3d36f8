"""The provided test tables seen as the six source tables and two change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTRACTED = "2024-02-01 00:00:00"

# Columns of the provided tables in use. Declared, so that no job infers them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


# A number drawn from the type's digest, so that no global numbering is needed.
CATEGORY_ID = "cast(conv(substring(md5(p_type), 1, 15), 16, 10) as bigint)"
STAMP = f"timestamp_ntz'{EXTRACTED}' as _extracted_at"


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    return (
        table(spark, sf, "customer")
        .join(places, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "c_custkey as id_customer",
            "concat('  ', c_name, ' ') as full_name",
            "concat(' ', c_name, '@Example.COM ') as email",
            "lpad(cast(c_custkey as string), 11, '0') as cpf",
            "concat('Rua ', c_custkey) as address",
            "n_name as city",
            "lower(substring(r_name, 1, 2)) as state",
            "lpad(cast(c_custkey as string), 8, '0') as zip_code",
            "timestamp_ntz'2000-01-01 00:00:00' as created_at",
            "timestamp_ntz'2000-01-02 03:04:05.678901' as updated_at",
            STAMP,
        )
    )


def raw_categories(spark: SparkSession, sf: str) -> DataFrame:
    kinds = table(spark, sf, "part").select("p_type").distinct()
    return kinds.selectExpr(
        f"{CATEGORY_ID} as id_category",
        "concat(' ', p_type, '  ') as category_name",
        "case when p_type <> 'PROMO' then concat('desc ', lower(p_type), ' ') end as description",
        STAMP,
    )


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey as id_product",
        "concat(' sku-', lpad(cast(p_partkey as string), 6, '0'), ' ') as sku",
        "concat(p_name, ' ') as product_name",
        f"{CATEGORY_ID} as id_category",
        "p_retailprice as sale_price",
        "p_retailprice * 0.5D as unit_cost",
        "p_size as current_stock",
        "timestamp_ntz'1995-01-01 00:00:00' as created_at",
        "timestamp_ntz'1995-01-01 00:00:00' as updated_at",
        STAMP,
    )


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as id_order",
        "o_custkey as id_customer",
        "o_orderdate as order_date",
        "o_totalprice as total_value",
        "get(array(0D, 12D, 19D, 29D), cast(o_orderkey % 4 as int)) as shipping_value",
        "decode(o_orderstatus, 'F', ' delivered', 'O', 'created ', 'shipped') as current_status",
        "o_orderdate as updated_at",
        STAMP,
    )


def raw_order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Lines have no unique number, so the key is drawn from a digest of the whole line."""
    numbers = [f"cast({c} as decimal(12,2))" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    exact = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *numbers, "l_shipdate", "l_returnflag", "l_linestatus"]
    line = ", ".join(f"cast({c} as string)" for c in exact)
    return table(spark, sf, "lineitem").selectExpr(
        f"cast(conv(substring(md5(concat_ws('|', {line})), 1, 15), 16, 10) as bigint) as id_item",
        "l_orderkey as id_order",
        "l_partkey as id_product",
        "cast(l_quantity as int) as quantity",
        "cast(l_extendedprice as decimal(10,2)) as unit_price",
        STAMP,
    )


def raw_payments(spark: SparkSession, sf: str) -> DataFrame:
    """One payment per order, a second for urgent ones, none yet for open ones of low priority."""
    tries = """explode(case when o_orderpriority = '5-LOW' and o_orderstatus = 'O' then cast(array() as array<int>)
        when o_orderpriority = '1-URGENT' then array(0, 1) else array(0) end) as n"""
    return (
        table(spark, sf, "orders")
        .selectExpr("*", tries)
        .selectExpr(
            "o_orderkey * 2 + n as id_payment",
            "o_orderkey as id_order",
            "get(array('pix ', ' credit_card', 'bank_slip'), cast((o_orderkey + n) % 3 as int)) as payment_method",
            "case when o_orderstatus = 'O' then 'pending' when n = 1 then 'rejected' else 'approved' end as payment_status",
            "cast(o_totalprice as decimal(10,2)) as amount",
            "case when o_orderstatus <> 'O' then o_orderdate end as payment_date",
            STAMP,
        )
    )


RAW = {
    "customers": raw_customers,
    "categories": raw_categories,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
}


def customer_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow change feed: every order is a change of its customer, some of them a deletion."""
    return table(spark, sf, "orders").selectExpr(
        "o_custkey as id_customer",
        "case when o_orderkey % 13 <> 0 then o_orderstatus end as segment",
        "o_orderdate as change_ts",
        "o_orderkey as change_version",
        "decode(cast(o_orderkey % 11 as int), 0, 'D', 1, 'I', 'U') as op",
    )


def product_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Price changes: the lines of orders, one change per part and day."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("id_product"), F.col("l_shipdate").alias("change_ts"))
        .agg(
            F.min("l_orderkey").alias("change_version"),
            F.expr("max(cast(l_extendedprice as decimal(10,2)))").alias("sale_price"),
        )
        .withColumn("op", F.lit("U"))
    )
