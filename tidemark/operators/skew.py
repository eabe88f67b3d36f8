"""Cutting the timeline of hot keys so that ordered windows never hold one key in one task.

A window over ``partitionBy(key).orderBy(ts)`` puts every row of a key into one task.
Here the few keys that are too large for that get cut points on their timeline, and the
window runs over ``(key, slice)`` instead. What a slice needs from its neighbours is one
row per slice; it is joined on (key, slice), by which the windowed rows are already
partitioned and sorted. The cut points only decide where rows are processed: results do
not depend on them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
ROWS_PER_SLICE = 4_000_000
SAMPLES_PER_SLICE = 200  # rows of a hot key that place one cut
SPREAD = 1024  # groups that rows without a key are dealt to at least
BROADCAST_KEYS = 1_000_000  # hot keys that are sent to every executor; more are joined by shuffle
_CUTS = "_cuts"


@dataclass(frozen=True)
class Cuts:
    """Cut points of the hot keys: local rows ``(key, ascending timestamps)``."""

    key_type: str
    rows: tuple[tuple[object, tuple[datetime, ...]], ...]
    spread: int = SPREAD

    @property
    def crowded(self) -> bool:
        """Whether one instant of a key fills a slice, so that time alone cannot cut it."""
        return any(len(set(points)) < len(points) for _, points in self.rows)

    @property
    def longest(self) -> int:
        return max((len(points) for _, points in self.rows), default=0)

    def mark(self, df: DataFrame, key: str) -> DataFrame:
        """Put the cut points beside each row, NULL for ordinary keys.

        The broadcast side holds at most one point per ``rows_per_slice`` rows; it is sent
        only while that is no more than :data:`BROADCAST_KEYS`.
        """
        frame = df.sparkSession.createDataFrame(
            [(k, list(points)) for k, points in self.rows], f"_hot {self.key_type}, {_CUTS} array<timestamp_ntz>"
        )
        small = sum(len(points) for _, points in self.rows) <= BROADCAST_KEYS
        return df.join(F.broadcast(frame) if small else frame, F.col(key) == F.col("_hot"), "left").drop("_hot")


def find_cuts(df: DataFrame, key: str, ts: str, rows_per_slice: int = ROWS_PER_SLICE) -> Cuts | None:
    """Cut points for the keys of ``df`` that hold more than ``rows_per_slice`` rows.

    Small input returns ``None`` after one count. Otherwise rows are counted per key, map
    tasks first, and every key above a slice gets as many slices as its own count asks
    for: evenly spaced rows of its timeline become the cuts. As cuts only steer where rows
    are processed, a sample places them, :data:`SAMPLES_PER_SLICE` rows a slice, so that
    sorting the sample of a key is a small task however hot the key. What reaches the
    driver is at most one cut per ``rows_per_slice`` rows.
    """
    rows = df.count()
    if rows <= rows_per_slice:
        return None
    known = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("k"), F.col(ts).alias("t"))
    hot = known.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_slice).select("k")
    if rows / rows_per_slice <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    rate = min(1.0, SAMPLES_PER_SLICE / rows_per_slice)
    some = known if rate == 1.0 else known.sample(rate, seed=1)
    place = F.row_number().over(Window.partitionBy("k").orderBy("t"))
    every = max(1, round(rows_per_slice * rate))
    cut = some.join(hot, "k").withColumn("place", place).filter(F.col("place") % every == 0)
    found = cut.groupBy("k").agg(F.array_sort(F.collect_list("t")).alias("p")).collect()
    spread = max(SPREAD, math.ceil(rows / rows_per_slice))
    if not found and spread == SPREAD:
        return None
    return Cuts(df.schema[key].dataType.simpleString(), tuple((r["k"], tuple(r["p"])) for r in found), spread)


def _points(value: Column, cuts: Cuts, inclusive: bool = False) -> Column:
    """How many cut points lie before ``value``: a binary search written as a fold."""
    points = F.col(_CUTS)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, cuts.longest.bit_length())))])

    def advance(found: Column, step: Column) -> Column:
        point = F.get(points, found + step - 1)
        return found + F.when(point <= value if inclusive else point < value, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), advance)


def with_slice(df: DataFrame, key: str, ts: str, cuts: Cuts | None, salt: Sequence[str] = ()) -> DataFrame:
    """Add the slice number of each row: 0 for ordinary keys, 1 and up along a hot key.

    Slices never run against time. With ``salt`` columns, rows that no timeline can
    spread are spread by their hash: rows without a key go to negative slices, and rows
    of one instant that fills several slices go to any of those.
    """
    spread = F.pmod(F.xxhash64(*salt), F.lit(cuts.spread if cuts else SPREAD)).cast("int") if salt else None
    if cuts is None:
        number = F.lit(0) if spread is None else F.when(F.col(key).isNull(), -1 - spread).otherwise(0)
        return df.withColumn(SLICE, number)
    at = F.col(ts)
    first = _points(at, cuts) + 1
    number = F.when(F.col(_CUTS).isNull(), 0)
    if spread is None:
        number = number.otherwise(first)
    else:
        tied = _points(at, cuts, inclusive=True) + 1 - first
        number = F.when(F.col(key).isNull(), -1 - spread).otherwise(number.otherwise(first + F.pmod(spread, tied + 1)))
    return cuts.mark(df, key).withColumn(SLICE, number.cast("int")).drop(_CUTS)


def neighbour(
    df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, cuts: Cuts | None, ahead: bool = False
) -> DataFrame:
    """Add the ``value`` of the previous (or next) row of the key, across slices.

    ``value`` must never be NULL (wrap it in a struct), as NULL means "no such row".
    The frame must already carry :data:`SLICE`.
    """
    by_order = [F.col(c) for c in order]
    within = Window.partitionBy(key, SLICE).orderBy(*by_order)
    near = (F.lead(value) if ahead else F.lag(value)).over(within)
    if cuts is None:
        return df.withColumn(name, near)
    pick = F.min_by if ahead else F.max_by
    edge = df.filter(F.col(SLICE) > 0).groupBy(key, SLICE).agg(pick(value, F.struct(*order)).alias("_edge"))
    along = Window.partitionBy(key).orderBy(SLICE)
    carried = edge.select(key, SLICE, (F.lead if ahead else F.lag)("_edge").over(along).alias("_carry"))
    return (
        df.withColumn("_near", near)
        .join(carried, [key, SLICE], "left")
        .withColumn(name, F.coalesce("_near", "_carry"))
        .drop("_near", "_carry")
    )
