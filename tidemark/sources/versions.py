"""A change table in Parquet as a stream whose offsets are the source's own versions.

A micro-batch is a range of versions, cut into partitions that are ranges too; a restarted
query goes on behind the last version that it has seen, whatever files the table consists of
by then. Files are skipped by the statistics of their version column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as arrow
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import needs_full_refresh
from tidemark.plans.store import Warehouse
from tidemark.streaming.feed import start_cdc

# Versions that one task reads.
STEP = 1_000_000


def _dataset(path: str) -> arrow.Dataset:
    if "://" not in path and not path.startswith("file:"):
        return arrow.dataset(path, format="parquet")
    system, inner = fs.FileSystem.from_uri(path)
    return arrow.dataset(inner, filesystem=system, format="parquet")


def version_range(path: str, version: str) -> tuple[int, int] | None:
    """Oldest and newest version that a change table holds, from the footers of its files."""
    low, high = [], []
    for fragment in _dataset(path).get_fragments():
        for group in fragment.row_groups:
            held = (group.statistics or {}).get(version)
            if held:
                low.append(held["min"])
                high.append(held["max"])
    return (min(low), max(high)) if low else None


@dataclass
class VersionRange(InputPartition):
    """Versions behind ``after`` up to ``until``."""

    after: int
    until: int


class ChangeTable(DataSource):
    """Options: ``path``; ``columns`` (DDL); ``version``, its column; ``after``, the version to start behind; ``step``."""

    @classmethod
    def name(cls) -> str:
        return "change_table"

    def schema(self) -> str:
        return self.options["columns"]

    def streamReader(self, schema) -> DataSourceStreamReader:
        return VersionReader(schema.fieldNames(), dict(self.options))


class VersionReader(DataSourceStreamReader):
    def __init__(self, columns: list[str], options: dict[str, str]):
        self.columns, self.path, self.version = columns, options["path"], options["version"]
        self.after, self.step = int(options["after"]), int(options.get("step", STEP))

    def initialOffset(self) -> dict:
        return {"version": self.after}

    def latestOffset(self) -> dict:
        held = version_range(self.path, self.version)
        return {"version": max(self.after, held[1] if held else self.after)}

    def partitions(self, start: dict, end: dict) -> list[VersionRange]:
        cuts = [*range(start["version"], end["version"], self.step), end["version"]]
        return [VersionRange(a, b) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: VersionRange) -> Iterator[pa.RecordBatch]:
        at = arrow.field(self.version)
        within = (at > partition.after) & (at <= partition.until)
        yield from (b for b in _dataset(self.path).to_batches(columns=self.columns, filter=within) if b.num_rows)

    def commit(self, end: dict) -> None:
        """Nothing to do: the versions seen are in the query's own log."""


def version_feed(spark: SparkSession, path: str, columns: str, version: str, after: int, step: int = STEP) -> DataFrame:
    """The changes behind a version, as a stream."""
    spark.dataSource.register(ChangeTable)
    options = {"path": path, "columns": columns, "version": version, "after": str(after), "step": str(step)}
    return spark.readStream.format(ChangeTable.name()).options(**options).load()


def follow_versions(
    warehouse: Warehouse,
    table: str,
    key: str,
    path: str,
    columns: str,
    current: Callable[[], DataFrame],
    checkpoint: str,
    version: str = "change_version",
    op: str = "op",
    interval: str | None = None,
    step: int = STEP,
) -> StreamingQuery | None:
    """Keep a raw table up with a change table.

    If the table was never filled, or changes behind its watermark are no longer held, it is
    replaced by ``current()`` as of the newest version, and a new stream starts behind that
    version; otherwise the stream goes on where it stopped. ``None`` without any change to start from.
    """
    name, spark = f"bronze/{table}", warehouse.spark
    held = version_range(path, version)
    if held is None:
        return None
    commit = warehouse.head()
    # All changes behind the watermark are there if the oldest is the next one or an earlier one.
    if needs_full_refresh(commit.watermarks.get(table), held[0] - 1, held[1]):
        commit = commit.next()
        warehouse.replace(commit, name, current(), key)
        commit.watermarks[table] = commit.streams[f"{name}:from"] = held[1]
        commit.streams.pop(name, None)  # batches are numbered anew
        warehouse.publish(commit)
    begun = commit.streams.get(f"{name}:from", commit.watermarks[table])
    feed = version_feed(spark, path, columns, version, begun, step)
    return start_cdc(feed, warehouse, table, key, [version], f"{checkpoint}/{table}-from-{begun}", op, version, interval)
