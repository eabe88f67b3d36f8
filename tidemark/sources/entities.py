"""The six source tables: columns, keys, and readers of their raw form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRACTED_AT = "_extracted_at"
OPERATION = "_operation"


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    columns: str  # Spark DDL of the source columns

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def raw_schema(self) -> T.StructType:
        return self.schema.add(EXTRACTED_AT, T.TimestampNTZType())

    @property
    def raw_name(self) -> str:
        return f"raw_{self.name}"


# Names, keys and columns of the source tables.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "customers",
            "id_customer",
            "id_customer bigint, full_name string, email string, cpf string, address string, city string, "
            "state string, zip_code string, created_at timestamp_ntz, updated_at timestamp_ntz",
        ),
        Entity("categories", "id_category", "id_category bigint, category_name string, description string"),
        Entity(
            "products",
            "id_product",
            "id_product bigint, sku string, product_name string, id_category bigint, sale_price decimal(10,2), "
            "unit_cost decimal(10,2), current_stock int, created_at timestamp_ntz, updated_at timestamp_ntz",
        ),
        Entity(
            "orders",
            "id_order",
            "id_order bigint, id_customer bigint, order_date timestamp_ntz, total_value decimal(10,2), "
            "shipping_value decimal(10,2), current_status string, updated_at timestamp_ntz",
        ),
        Entity(
            "order_items",
            "id_item",
            "id_item bigint, id_order bigint, id_product bigint, quantity int, unit_price decimal(10,2), "
            "subtotal decimal(21,2)",
        ),
        Entity(
            "payments",
            "id_payment",
            "id_payment bigint, id_order bigint, payment_method string, payment_status string, "
            "amount decimal(10,2), payment_date timestamp_ntz",
        ),
    )
}


def read_schema(source: DataFrame, required: bool = True) -> T.StructType | None:
    """Lower-cased columns of a source table in their order.

    A table without columns is an error when it is about to be ingested and is
    skipped (``None``) when targets are only being prepared.
    """
    if not source.schema.fields:
        if required:
            raise ValueError("source table has no columns")
        return None
    return T.StructType([T.StructField(f.name.lower(), f.dataType, True) for f in source.schema.fields])


def schema_rows(source: DataFrame) -> DataFrame:
    """The same schema as rows, with precision and scale of exact numerics, for comparison and storage."""
    rows = []
    for place, field in enumerate(read_schema(source).fields, start=1):
        exact = isinstance(field.dataType, T.DecimalType)
        size = (field.dataType.precision, field.dataType.scale) if exact else (None, None)
        rows.append((place, field.name, "decimal" if exact else field.dataType.typeName(), *size))
    kinds = "ordinal int, column_name string, data_type string, numeric_precision int, numeric_scale int"
    return source.sparkSession.createDataFrame(rows, kinds)


def bronze(spark: SparkSession, location: str, name: str) -> DataFrame:
    """One of the six declared raw tables, read with its declared schema."""
    if name not in ENTITIES:
        raise KeyError(f"no raw table is declared for {name!r}")
    return spark.read.schema(ENTITIES[name].raw_schema).parquet(location)


def full_extract(source: DataFrame) -> DataFrame:
    """Every source row, marked as an insert."""
    return source.withColumn(OPERATION, F.lit("I"))


def incremental_extract(
    log: DataFrame,
    source: DataFrame,
    key: str,
    last: int,
    upper: int | None = None,
    op: str = "op",
    version: str = "change_version",
    absent_is_delete: bool = False,
) -> DataFrame:
    """Changes after ``last`` with the current source row beside them.

    The key comes from the change, every other column from the source, so a deleted
    row arrives with NULLs. The version predicate reaches the scan of the log.
    Rows are not sorted: the version column is kept to pick the last change by.
    With ``absent_is_delete`` a change whose row is gone by now counts as its deletion,
    rather than as a row of NULLs.
    """
    window = F.col(version) > last
    if upper is not None:
        window = window & (F.col(version) <= upper)
    changes = log.filter(window).select(key, version, F.col(op).alias(OPERATION))
    payload = [c for c in source.columns if c != key]
    joined = changes.join(source.select(key, *payload, F.lit(True).alias("_found")), key, "left")
    if absent_is_delete:
        joined = joined.withColumn(OPERATION, F.when(F.col("_found"), F.col(OPERATION)).otherwise("D"))
    return joined.select(key, *payload, OPERATION, version)
