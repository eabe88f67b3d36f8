"""Data tests. Each returns the violating rows; a table passes when none come back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import missing_or_out_of_range, year_out_of_range
from tidemark.operators.ranges import overlapping_pairs
from tidemark.operators.skew import Cuts


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row counts; NULL is no value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return counts.agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_rows)`` for every listed column, all counted in one scan."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in columns])
    return totals.select(F.inline(pairs))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_counts(df, columns).filter("n_rows > 0")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their row counts.

    Both sides are reduced to distinct values before the join, so a value that fills a
    third of a table reaches it as one row per map task.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return used.agg(F.count("*").alias("n_rows")).join(known, "value", "left_anti")


# Keys per 4-KB bitmap that make bitmaps worth their size, against the rows they stand for.
DENSE = 256


def _bitmaps(values: DataFrame) -> DataFrame:
    """``bucket, bits``: the distinct integers of ``value`` as bitmaps of a fixed size, a bit each; NULL is no value."""
    known = values.filter("value is not null").select(F.col("value").cast("bigint").alias("value"))
    return known.groupBy(F.bitmap_bucket_number("value").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
    )


def _dense(values: DataFrame) -> bool:
    """Whether integers lie close enough together for bitmaps to be smaller than the values themselves."""
    if values.schema["value"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        return False
    low, high, rows = values.agg(F.min("value"), F.max("value"), F.count("value")).first()
    return rows > 0 and (high - low) // 32_768 + 1 <= max(1, rows // DENSE)


def unique_by_bitmap(df: DataFrame, column: str) -> DataFrame:
    """:func:`unique`, decided by bitmaps: rows are listed only if there are fewer distinct values than rows.

    A task sends a bit for each value it met, and not the value. Values that lie too far
    apart for that, or are no integers, are grouped as ever.
    """
    values = df.select(F.col(column).alias("value"))
    if _dense(values):
        whole = _bitmaps(values).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        distinct = whole.agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0
        if distinct == values.agg(F.count("value")).first()[0]:
            return unique(df.limit(0), column)
    return unique(df, column)


def relationships_by_bitmap(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """:func:`relationships`, decided by bitmaps: child values beyond the parent's are listed only if there are any."""
    used, known = child.select(F.col(column).alias("value")), parent.select(F.col(parent_column).alias("value"))
    if _dense(used) and _dense(known):
        both = _bitmaps(used).withColumn("known", F.lit(False)).unionByName(_bitmaps(known).withColumn("known", F.lit(True)))
        merged = both.groupBy("bucket").agg(
            F.bitmap_or_agg("bits").alias("either"), F.expr("bitmap_or_agg(bits) filter (where known)").alias("parents")
        )
        # Bits of either side that are none of the parent's are the child's alone.
        beyond = F.bitmap_count("either") - F.coalesce(F.bitmap_count("parents"), F.lit(0))
        if not (merged.agg(F.sum(beyond)).first()[0] or 0):
            return relationships(child.limit(0), column, parent, parent_column)
    return relationships(child, column, parent, parent_column)


def footer_counts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """:func:`null_counts` of a Parquet table, answered from the footers of its files: no column is read.

    Goes through Spark's second reader, which hands counts down to the files; files without
    statistics make it refuse, and the columns are then counted.
    """
    amounts = [F.count("*").alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in columns]]
    with _settings(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        counts = spark.read.parquet(path).agg(*amounts)
        try:
            held = counts.first()
        except UnsupportedOperationException:
            held = None
    if held is None:
        return null_counts(spark.read.parquet(path), columns)
    return spark.createDataFrame([(c, held["_rows"] - held[c]) for c in columns], "column_name string, n_rows bigint")


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]):
    """Runtime settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def field_violations(df: DataFrame, table: str, record_id: str, rules: Mapping[str, Column]) -> DataFrame:
    """``(field_name, record_id)`` for every broken rule, in one scan of the table.

    The rules are also one filter, which Parquet uses to skip clean row groups.
    """
    broken = reduce(lambda a, b: a | b, rules.values())
    hits = F.array(*[F.when(bad, F.lit(f"{table}.{name}")) for name, bad in rules.items()])
    return df.filter(broken).select(
        F.explode(F.array_compact(hits)).alias("field_name"), F.col(record_id).cast("string").alias("record_id")
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Staged dates that must be present and in range, by table, and each table's key.
STAGED_DATES = {
    "customers": ("id_customer", ("created_at", "updated_at", "_extracted_at")),
    "products": ("id_product", ("created_at", "updated_at", "_extracted_at")),
    "orders": ("id_order", ("order_date", "updated_at", "_extracted_at")),
    "payments": ("id_payment", ("_extracted_at",)),
    "order_items": ("id_item", ("_extracted_at",)),
    "categories": ("id_category", ("_extracted_at",)),
}
SNAPSHOT_DATES = ("dbt_updated_at", "dbt_valid_from", "dbt_valid_to", "created_at", "updated_at")


def staging_date_rules(name: str) -> dict[str, Column]:
    """What must not hold for a row of a staged table; only a pending payment may lack its date."""
    rules = {d: missing_or_out_of_range(F.col(d)) for d in STAGED_DATES[name][1]}
    if name == "payments":
        paid = F.col("payment_date")
        rules["payment_date"] = year_out_of_range(paid) | (paid.isNull() & (F.col("payment_status") != "PENDING"))
    return rules


def gold_date_rules(name: str) -> dict[str, Column]:
    """What must not hold for a row of a dimension or the fact; ends and payment dates may be absent."""
    if name == "fct_orders":
        rules = {c: missing_or_out_of_range(F.col(c)) for c in ("order_date", "updated_at")}
        return {**rules, "payment_date": year_out_of_range(F.col("payment_date"))}
    rules = {c: missing_or_out_of_range(F.col(c)) for c in ("created_at", "updated_at", "valid_from")}
    return {**rules, "valid_to": year_out_of_range(F.col("valid_to"))}


def snapshot_date_rule() -> Column:
    """Any impossible date; a missing one is no violation here."""
    return reduce(lambda a, b: a | b, [year_out_of_range(F.col(d)) for d in SNAPSHOT_DATES])


def staging_dates(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Missing or impossible dates in Silver."""
    tables = STAGED_DATES.items()
    return _union([field_violations(staged[n], f"stg_{n}", record_id, staging_date_rules(n)) for n, (record_id, _) in tables])


def gold_dates(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Missing or impossible dates in Gold."""
    tables = (("dim_customers", customers, "customer_sk"), ("dim_products", products, "product_sk"), ("fct_orders", orders, "order_id"))
    return _union([field_violations(df, name, record_id, gold_date_rules(name)) for name, df, record_id in tables])


def snapshot_dates(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Versions with any impossible date."""

    def broken(df: DataFrame, name: str, key: str) -> DataFrame:
        bad = df.filter(snapshot_date_rule())
        return bad.select(F.lit(name).alias("snapshot_name"), F.col(key).cast("string").alias("record_id"))

    return broken(customers, "snapshot_customers", "id_customer").unionByName(
        broken(products, "snapshot_products", "id_product")
    )


def _per_dimension(customers: DataFrame, products: DataFrame, test) -> DataFrame:
    found = []
    for name, df, key, sk in (
        ("customers", customers, "customer_id", "customer_sk"),
        ("products", products, "product_id", "product_sk"),
    ):
        rows = test(df, key, sk)
        rest = [c for c in rows.columns if c != "business_key"]
        found.append(
            rows.select(
                F.lit(name).alias("dimension_name"), F.col("business_key").cast("string").alias("business_key"), *rest
            )
        )
    return _union(found)


def several_current(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Business keys with more than one current version."""

    def test(df: DataFrame, key: str, sk: str) -> DataFrame:
        counts = df.filter("is_current").groupBy(F.col(key).alias("business_key")).count()
        return counts.filter("count > 1").drop("count")

    return _per_dimension(customers, products, test)


def empty_ranges(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Versions that end at or before their start."""

    def test(df: DataFrame, key: str, sk: str) -> DataFrame:
        return df.filter("valid_to <= valid_from").select(F.col(key).alias("business_key"), "valid_from", "valid_to")

    return _per_dimension(customers, products, test)


def overlaps(
    customers: DataFrame, products: DataFrame, customer_cuts: Cuts | None = None, product_cuts: Cuts | None = None
) -> DataFrame:
    """Pairs of versions of one business key whose ranges overlap."""
    cuts = {"customer_id": customer_cuts, "product_id": product_cuts}
    return _per_dimension(customers, products, lambda df, key, sk: overlapping_pairs(df, key, sk, cuts[key]))
