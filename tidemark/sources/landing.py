"""The landing area: one fresh Parquet folder per table and run, counted on write and load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.conform import assert_count, load_by_name
from tidemark.operators.digests import Digest, assert_same, digest_columns, digest_of, row_hash
from tidemark.sources.files import Files


def new_run_id() -> str:
    return uuid.uuid4().hex


def landing_path(root: str, table: str, run_id: str) -> str:
    return f"{root}/landing/{table}/{run_id}"


def land(df: DataFrame, root: str, table: str, run_id: str) -> tuple[str, int]:
    """Write a batch to its own folder; the row count is observed while writing."""
    path = landing_path(root, table, run_id)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("compression", "snappy").mode("errorifexists").parquet(path)
    return path, seen.get["rows"]


def land_digested(df: DataFrame, root: str, table: str, run_id: str) -> tuple[str, Digest]:
    """Write a batch to its own folder; what it holds is observed while writing, in the same pass."""
    path = landing_path(root, table, run_id)
    seen = Observation()
    watched = df.observe(seen, *digest_columns(row_hash(df.columns)))
    watched.write.option("compression", "snappy").mode("errorifexists").parquet(path)
    return path, Digest.of(seen.get)


def load(spark: SparkSession, path: str, schema: T.StructType, expected: int | Digest | None = None) -> DataFrame:
    """Typed rows of a landed batch; rows other than those extracted, or another number of them, are an error."""
    landed = spark.read.parquet(path)
    if isinstance(expected, Digest):
        assert_same(expected, digest_of(landed), path)
    elif expected is not None:
        assert_count(expected, landed.count(), path)
    return load_by_name(landed, schema)


def purge(spark: SparkSession, path: str) -> bool:
    return Files(spark).delete(path)
