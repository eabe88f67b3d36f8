"""The 39 declared data tests, and a report of their violation counts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.skew import find_cuts

Tables = Mapping[str, DataFrame]

# Which columns are tested, by table.
STAGING_KEYS = {
    "stg_customers": "id_customer",
    "stg_categories": "id_category",
    "stg_products": "id_product",
    "stg_orders": "id_order",
    "stg_order_items": "id_item",
    "stg_payments": "id_payment",
}
UNIQUE = {**STAGING_KEYS, "dim_customers": "customer_sk", "dim_products": "product_sk", "fct_orders": "order_id"}
NOT_NULL = {
    **{table: (key,) for table, key in STAGING_KEYS.items()},
    "dim_customers": ("customer_sk", "customer_id", "email", "valid_from", "is_current"),
    "dim_products": ("product_sk", "product_id", "sku", "category_id", "valid_from", "is_current"),
    "fct_orders": ("order_id", "customer_id", "customer_sk", "order_total"),
}
RELATIONSHIPS = (
    ("dim_products", "category_id", "stg_categories", "id_category"),
    ("fct_orders", "customer_id", "dim_customers", "customer_id"),
    ("fct_orders", "customer_sk", "dim_customers", "customer_sk"),
)


def _staged(tables: Tables) -> dict[str, DataFrame]:
    return {table.removeprefix("stg_"): tables[table] for table in STAGING_KEYS}


SINGULAR: Mapping[str, tuple[tuple[str, ...], Callable[[Tables], DataFrame]]] = {
    "staging_dates": (tuple(STAGING_KEYS), lambda t: checks.staging_dates(_staged(t))),
    "gold_dates": (
        ("dim_customers", "dim_products", "fct_orders"),
        lambda t: checks.gold_dates(t["dim_customers"], t["dim_products"], t["fct_orders"]),
    ),
    "snapshot_dates": (
        ("snapshot_customers", "snapshot_products"),
        lambda t: checks.snapshot_dates(t["snapshot_customers"], t["snapshot_products"]),
    ),
    "several_current": (
        ("dim_customers", "dim_products"),
        lambda t: checks.several_current(t["dim_customers"], t["dim_products"]),
    ),
    "empty_ranges": (
        ("dim_customers", "dim_products"),
        lambda t: checks.empty_ranges(t["dim_customers"], t["dim_products"]),
    ),
    "overlaps": (
        ("dim_customers", "dim_products"),
        lambda t: checks.overlaps(
            t["dim_customers"],
            t["dim_products"],
            find_cuts(t["dim_customers"], "customer_id", "valid_from"),
            find_cuts(t["dim_products"], "product_id", "valid_from"),
        ),
    ),
}


def declared_tests() -> list[str]:
    names = [f"unique:{t}.{c}" for t, c in UNIQUE.items()]
    names += [f"not_null:{t}.{c}" for t, columns in NOT_NULL.items() for c in columns]
    names += [f"relationships:{t}.{c}" for t, c, _, _ in RELATIONSHIPS]
    return names + list(SINGULAR)


def run_tests(tables: Tables, select: Iterable[str] | None = None) -> DataFrame:
    """``(test, violations)`` for the chosen tests, all in one job.

    NULLs of a table are counted together in one scan. A test names the tables it reads;
    choosing tests of missing tables raises ``KeyError``.
    """
    chosen = set(declared_tests() if select is None else select)
    unknown = chosen - set(declared_tests())
    if unknown:
        raise KeyError(f"unknown tests: {sorted(unknown)}")
    counts: list[DataFrame] = []

    def add(name: str, violations: DataFrame, amount=F.count("*")) -> None:
        total = F.coalesce(amount.cast("bigint"), F.lit(0).cast("bigint"))
        counts.append(violations.agg(total.alias("violations")).select(F.lit(name).alias("test"), "violations"))

    for table, column in UNIQUE.items():
        if (name := f"unique:{table}.{column}") in chosen:
            add(name, checks.unique(tables[table], column))
    for table, columns in NOT_NULL.items():
        wanted = [c for c in columns if f"not_null:{table}.{c}" in chosen]
        if wanted:
            nulls = checks.null_counts(tables[table], wanted)
            counts.append(
                nulls.select(
                    F.concat(F.lit(f"not_null:{table}."), "column_name").alias("test"),
                    F.col("n_rows").cast("bigint").alias("violations"),
                )
            )
    for child, column, parent, parent_column in RELATIONSHIPS:
        if (name := f"relationships:{child}.{column}") in chosen:
            add(name, checks.relationships(tables[child], column, tables[parent], parent_column), F.sum("n_rows"))
    for name, (_, test) in SINGULAR.items():
        if name in chosen:
            add(name, test(tables))
    return reduce(DataFrame.unionByName, counts)


def tests_of(*tables: str) -> list[str]:
    """Tests that need nothing beyond the given tables."""
    have = set(tables)
    names = [f"unique:{t}.{c}" for t, c in UNIQUE.items() if t in have]
    names += [f"not_null:{t}.{c}" for t, columns in NOT_NULL.items() for c in columns if t in have]
    names += [f"relationships:{t}.{c}" for t, c, p, _ in RELATIONSHIPS if t in have and p in have]
    return names + [name for name, (needed, _) in SINGULAR.items() if have.issuperset(needed)]
