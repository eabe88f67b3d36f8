"""A change feed as a stream: each micro-batch is merged into a raw table exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import latest_per_key
from tidemark.plans.store import Warehouse
from tidemark.sources.entities import OPERATION
from tidemark.sources.landing import new_run_id, purge


def file_feed(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """Change files in the order of their arrival."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("latestFirst", "false").parquet(folder)


def start_cdc(
    feed: DataFrame,
    warehouse: Warehouse,
    table: str,
    key: str,
    order: Sequence[str],
    checkpoint: str,
    op: str = "op",
    version: str = "change_version",
    interval: str | None = None,
) -> StreamingQuery:
    """Merge a feed of ``table`` columns plus version and operation.

    With an ``interval`` (such as ``5 minutes``) the query keeps running and its batches
    never overlap; without one it takes what is there and stops. The batch number is part
    of the commit, so a batch that is replayed after a failure is recognised and skipped.
    Other columns of the feed are dropped.
    """
    name = f"bronze/{table}"

    def merge_batch(batch: DataFrame, number: int) -> None:
        head = warehouse.head()
        if head.streams.get(name, -1) >= number:
            return
        commit = head.next()
        columns = T.StructType.fromJson(commit.tables[name]["schema"]).fieldNames()
        reached = batch.agg(F.max(version)).first()[0]
        if reached is not None:
            newest = latest_per_key(batch.filter(F.col(key).isNotNull()), [key], order)
            # Written once and read from there, as the merge looks at it more than once.
            landed = f"{warehouse.root}/landing/{table}/{new_run_id()}"
            newest.withColumn(OPERATION, F.col(op)).select(*columns, OPERATION).write.parquet(landed)
            warehouse.merge_into(commit, name, warehouse.spark.read.parquet(landed), key)
            commit.watermarks[table] = max(reached, commit.watermarks.get(table, reached))
        commit.streams[name] = number
        warehouse.publish(commit)
        if reached is not None:
            purge(warehouse.spark, landed)

    writer = feed.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
