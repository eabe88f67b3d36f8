"""Tables that Spark knows to be bucketed and sorted by their key.

Joins and grouping on the key of such tables need no exchange, and no sort where a bucket is
one file. They are for tables that are rewritten as a whole and joined often: the catalog
replaces a table at once, while the slots of a :class:`~tidemark.plans.store.Warehouse` are
rewritten one by one and published together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import Files


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` as the table ``name``, in ``buckets`` files by the hash of ``key``, each sorted by it.

    Tables that are to be joined take the same number of buckets; :func:`~tidemark.plans.store.buckets_for`
    proposes one.
    """
    # Dealt by the same hash as the buckets, so that every bucket becomes one file.
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def drop_bucketed(spark: SparkSession, name: str, path: str) -> None:
    """Take a table out of the catalog and delete its files."""
    spark.sql(f"drop table if exists {name}")
    Files(spark).delete(path)
