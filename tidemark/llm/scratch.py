"""Tables of one job in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir
from tidemark.sources.files import Files


class Scratch:
    """A folder of its own under ``spark.checkpoint.dir``; what is written there cuts the lineage and outlives executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it is read back from a table of that name."""
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that no later frame reads."""
        Files(self.spark).delete(f"{self.folder}/{name}")
