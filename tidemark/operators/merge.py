"""Change-set algebra: bounds, refresh decision, last change per key, merges, watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import BROADCAST_KEYS
from tidemark.session import written
from tidemark.sources.entities import OPERATION

STATE_SCHEMA = "table_name string, last_sync_version bigint"


def version_bounds(log: DataFrame, version: str = "change_version") -> DataFrame:
    """One row: newest version of the log and the oldest one it still holds."""
    return log.agg(F.max(version).cast("bigint").alias("upper"), F.min(version).cast("bigint").alias("min_valid"))


def read_bounds(log: DataFrame, version: str = "change_version") -> tuple[int, int]:
    row = version_bounds(log, version).first()
    if row["upper"] is None:
        raise RuntimeError("the source reports no current version; change tracking is off")
    return row["upper"], row["min_valid"]


def watermark(state: DataFrame, table: str) -> DataFrame:
    """Last synced version of a table: one row, or none if it was never synced."""
    return state.filter(F.col("table_name") == table).select("last_sync_version")


def refresh_decision(last: Column, min_valid: Column, upper: Column) -> Column:
    """Full refresh when the watermark is lost, expired or ahead of the source."""
    lost = last.isNull() | min_valid.isNull()
    return F.coalesce(lost | (last < min_valid) | (last > upper), F.lit(True))


def needs_full_refresh(last: int | None, min_valid: int | None, upper: int) -> bool:
    if last is None or min_valid is None:
        return True
    return not min_valid <= last <= upper


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns.

    Spark turns the ``= 1`` filter into a group limit that runs before the shuffle, so
    each map task sends at most one row per key, however hot the key is.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def merge(target: DataFrame, changes: DataFrame, key: str, op: str = OPERATION) -> DataFrame:
    """Target after the batch; the batch holds at most one row per key.

    Matched deletes vanish, matched rows are replaced, unmatched non-deletes are added,
    unmatched deletes are ignored. A NULL operation replaces a matched row and never
    inserts. A small batch is broadcast by AQE once its size is known, so the target is
    streamed and not shuffled; without a NULL operation the branch for it turns out empty
    at run time and is dropped.
    """
    columns = target.columns
    kept = target.join(changes.select(key), key, "left_anti")
    written = changes.filter(F.col(op) != "D")
    unmarked = changes.filter(F.col(op).isNull()).join(target.select(key), key, "left_semi")
    return kept.select(*columns).unionByName(written.select(*columns)).unionByName(unmarked.select(*columns))


def full_refresh(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Target replaced by the batch: every key's last row is upserted, absent keys are deleted.

    No join with the old rows is needed, as the outcome does not depend on them. A row without a
    key matches nothing and so does not survive the delete half. A split read can bring a
    key twice; its last row by the ``order`` columns stays, the other columns breaking ties.
    Keys are counted first, so that only rows of keys that came twice are sorted; up to
    :data:`BROADCAST_KEYS` of these are sent to every task, and all other rows stay where they are.
    """
    known = batch.filter(F.col(key).isNotNull()).select(*target.columns)
    twice = written(known.groupBy(F.col(key).alias("_twice")).count().filter("count > 1").select("_twice"))
    n = twice.count()
    if not n:
        return known
    twice = F.broadcast(twice) if n <= BROADCAST_KEYS else twice
    same = F.col(key) == F.col("_twice")
    ties = [c for c in target.columns if c != key and c not in order]
    newest = latest_per_key(known.join(twice, same, "left_semi"), [key], [*order, *ties])
    return known.join(twice, same, "left_anti").unionByName(newest)


def advance(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Watermark table with the given ``(table_name, last_sync_version)`` rows upserted."""
    return merge(state, updates.withColumn(OPERATION, F.lit("U")), "table_name")


def advance_if_empty(
    target: DataFrame, state: DataFrame, batch: DataFrame, key: str, updates: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Target and watermarks after an incremental batch.

    Without changes the target frame itself comes back, so nothing is rewritten and only
    the watermark moves.
    """
    return (target if batch.isEmpty() else merge(target, batch, key)), advance(state, updates)
