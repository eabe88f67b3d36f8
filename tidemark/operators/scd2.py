"""Type 2 history: one check-strategy step, and a whole ordered feed in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import distinct_from, ntz, version_key
from tidemark.operators.merge import latest_per_key
from tidemark.operators.skew import BROADCAST_KEYS, SLICE, Cuts, neighbour, with_slice
from tidemark.session import written

SCD_ID, UPDATED, FROM, TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
# Column of a stored history with the digest of its check columns.
DIGEST = "check_digest"
# The metadata columns of a history table.
METADATA = T.StructType(
    [T.StructField(SCD_ID, T.StringType()), *[T.StructField(c, T.TimestampNTZType()) for c in (UPDATED, FROM, TO)]]
)


def history_schema(payload: T.StructType) -> T.StructType:
    return T.StructType([*payload.fields, *METADATA.fields])


def empty_history(source: DataFrame) -> DataFrame:
    return source.sparkSession.createDataFrame([], history_schema(source.schema))


def assert_unique(df: DataFrame, key: str, what: str = "snapshot source") -> None:
    """Stop when a key occurs twice; a step over such a source has no defined result."""
    if not df.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{what}: {key} is not unique")


def scd2_step(
    open_versions: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | str,
    hard_deletes: bool = True,
) -> DataFrame:
    """What becomes of the open versions, plus the versions that open now.

    One full outer join on the key; each joined row yields the old version (kept or
    closed at ``run_ts``), a new version, or both. Closed history is not read.
    """
    payload = source.columns
    now = ntz(str(run_ts))
    old = F.struct(*[F.col(c) for c in (*payload, *METADATA.names)])
    new = F.struct(
        *[F.col(c) for c in payload],
        F.md5(F.concat_ws("|", F.col(key).cast("string"), now.cast("string"))).alias(SCD_ID),
        now.alias(UPDATED),
        now.alias(FROM),
        F.lit(None).cast("timestamp_ntz").alias(TO),
    )
    left = open_versions.select(F.col(key).alias("_key"), old.alias("_old"))
    right = source.select(F.col(key).alias("_key"), new.alias("_new"))
    both = left.join(right, "_key", "full_outer")
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    watched = [F.struct(*[F.col(f"{side}.{c}") for c in check_cols]) for side in ("_old", "_new")]
    differs = had & has & distinct_from(*watched)
    gone = had & ~has & F.lit(hard_deletes)
    kept = F.when(differs | gone, F.col("_old").withField(TO, now)).otherwise(F.col("_old"))
    rows = F.array(F.when(had, kept), F.when(has & (~had | differs), F.col("_new")))
    return both.select(F.inline(F.array_compact(rows)))


def check_digest(check_cols: Sequence[str]) -> Column:
    """128 bits that tell values of the check columns apart, NULLs included."""
    # A hash skips NULLs, so that which columns are NULL is a value of its own.
    empty = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in check_cols])
    columns = [F.col(c) for c in check_cols]
    return F.struct(F.xxhash64(empty, *columns).alias("a"), F.xxhash64(*reversed(columns), empty, F.lit(1)).alias("b"))


def changed_keys(open_versions: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], hard_deletes: bool = True) -> DataFrame:
    """Keys for which a step may do anything: new ones, those gone, and those whose check columns have another digest.

    Nothing but key and digest moves. A column :data:`DIGEST` is taken where a side has it, so
    that a stored history is asked for two columns only.
    """

    def narrow(df: DataFrame, name: str) -> DataFrame:
        digest = F.col(DIGEST) if DIGEST in df.columns else check_digest(check_cols)
        return df.select(F.col(key).alias("_key"), F.coalesce(digest, check_digest(check_cols)).alias(name))

    both = narrow(open_versions, "_old").join(narrow(source, "_new"), "_key", "full_outer")
    moved = ~F.col("_old").eqNullSafe(F.col("_new"))
    if not hard_deletes:
        moved = moved & F.col("_new").isNotNull()
    return both.filter(moved).select("_key").distinct()


def scd2_step_changed(
    open_versions: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | str,
    hard_deletes: bool = True,
    most: int = BROADCAST_KEYS,
) -> DataFrame:
    """:func:`scd2_step` in two phases: find the keys that changed, then move the rows of those alone.

    Up to ``most`` changed keys are sent to every task, so that rows of other keys pass without
    a shuffle. A digest says which keys to look at; what becomes of them is decided by
    their values.
    """
    keys = written(changed_keys(open_versions, source, key, check_cols, hard_deletes))
    if keys.count() <= most:
        keys = F.broadcast(keys)
    same = F.col(key).eqNullSafe(F.col("_key"))
    stepped = scd2_step(
        open_versions.join(keys, same, "left_semi"), source.join(keys, same, "left_semi"), key, check_cols, run_ts, hard_deletes
    )
    return open_versions.join(keys, same, "left_anti").select(*stepped.columns).unionByName(stepped)


def scd2_apply(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | str,
    hard_deletes: bool = True,
    step=scd2_step,
) -> DataFrame:
    """Whole history after one run over the current source; ``step`` may be :func:`scd2_step_changed`."""
    closed = history.filter(F.col(TO).isNotNull())
    return closed.unionByName(step(history.filter(F.col(TO).isNull()), source, key, check_cols, run_ts, hard_deletes))


def scd2_fold(
    changes: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: str = "change_ts",
    version: str = "change_version",
    op: str = "op",
    cuts: Cuts | None = None,
) -> DataFrame:
    """History of a whole ordered change feed, equal to applying its batches one by one.

    A batch is all changes of one ``ts``; the last by ``version`` counts. All windows
    share partitioning and order, so ordinary keys need one shuffle and one sort. Hot
    keys are cut along time (``cuts``) and looked up across slices. Only where a single
    instant of a key fills whole slices are its ties removed before that shuffle.
    """
    payload = [c for c in changes.columns if c not in (ts, version, op)]
    order = [ts, version]
    feed = changes.filter(F.col(key).isNotNull())
    if cuts is not None and cuts.crowded:
        feed = latest_per_key(feed, [key, ts], [version])
    feed = with_slice(feed, key, ts, cuts)
    # Changes of one instant share a slice, so the last of them is known within it.
    following = F.lead(ts).over(Window.partitionBy(key, SLICE).orderBy(*order))
    feed = feed.withColumn("_after", following).filter(~F.col("_after").eqNullSafe(F.col(ts))).drop("_after")
    watched = F.struct(*check_cols)
    seen = neighbour(feed, key, order, F.struct(F.col(op).alias("op"), watched.alias("watched")), "_before", cuts)
    was_open = F.col("_before").isNotNull() & (F.col("_before.op") != "D")
    opens = (F.col(op) != "D") & (~was_open | distinct_from(F.col("_before.watched"), watched))
    closes = (F.col(op) == "D") & was_open
    bounds = neighbour(seen.filter(opens | closes), key, order, F.struct(ts), "_next", cuts, ahead=True)
    return (
        bounds.filter(F.col(op) != "D")
        .withColumns({UPDATED: F.col(ts), FROM: F.col(ts), TO: F.col(f"_next.{ts}")})
        .withColumn(SCD_ID, version_key([key], FROM))
        .select(*payload, *METADATA.names)
    )
