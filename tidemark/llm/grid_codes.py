"""Product codes of vectors, assigned through memoised grid cells.

A vector is cut into equal parts, each coded by the nearest entry of its own codebook. A part
falls into a coarse cell of a grid. For each cell met, the entries that can be nearest anywhere
in its box are worked out once, by least and greatest distance, and kept; only those are then
evaluated, exactly and in integers, for the parts inside. The grid saves work where parts
crowd together and never changes a result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import Scratch

PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Grid values are floor(SCALE * x).
SCALE = 1024
# Cells are 2**CELL_BITS wide along every axis.
CELL_BITS = 5
# Cells whose candidates a task remembers for a part, and rows that it works on at once.
MEMORY = 20_000
ROWS = 4096


def _limit(size: int) -> int:
    """Largest magnitude of a grid value for which a whole vector's squared distance fits a long."""
    return math.isqrt(2**60 // size)


def _grid(column: str):
    """Kept rows with ``grid``: integer components of vectors that have ``PARTS`` equal parts and finite values only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            vectors = batch.column(at)
            rows, grids = [], []
            for i, one in enumerate(vectors):
                if one.values is None:
                    continue
                x = one.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not len(x) or len(x) % PARTS or not np.isfinite(x).all():
                    continue
                if np.abs(x).max() * SCALE >= _limit(len(x)):
                    continue
                rows.append(i)
                grids.append(np.floor(x * SCALE).astype(np.int32))
            rest = [c.take(pa.array(rows, pa.int64())) for k, c in enumerate(batch.columns) if k != at]
            offsets = np.concatenate([[0], np.cumsum([len(g) for g in grids])]).astype(np.int32)
            values = np.concatenate(grids) if grids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            names = [n for k, n in enumerate(batch.schema.names) if k != at]
            yield pa.RecordBatch.from_arrays([*rest, lists], names=[*names, "grid"])

    return work


class CellCache:
    """Nearest entries of one codebook, with the candidates of each grid cell met so far."""

    def __init__(self, codebook: np.ndarray, bits: int = CELL_BITS):
        self.codebook, self.bits = codebook.astype(np.int64), bits
        self.known: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _bounds(self, axis: int, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance along one axis between intervals from ``low`` on and every entry."""
        low, entry = low[:, None], self.codebook[:, axis]
        high = low + ((1 << self.bits) - 1)
        least = np.maximum(np.maximum(low - entry, entry - high), 0) ** 2
        # The far end of the interval is its upper or its lower one.
        return least, np.maximum(high - entry, entry - low) ** 2

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell: the entries whose least distance to its box is at most some entry's greatest."""
        least = np.zeros((len(cells), len(self.codebook)), np.int64)
        most = np.zeros_like(least)
        for axis in range(cells.shape[1]):
            # Cells share the few intervals of an axis.
            steps, which = np.unique(cells[:, axis], return_inverse=True)
            near, far = self._bounds(axis, steps.astype(np.int64) << self.bits)
            least += near[which]
            most += far[which]
        keep = least <= most.min(1)[:, None]
        ends = np.cumsum(keep.sum(1))[:-1]
        return np.split(np.nonzero(keep)[1], ends)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each part's nearest entry, the lower one of two as near, and its squared distance."""
        cells = np.ascontiguousarray(parts >> self.bits)
        keys = cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        names = [k.tobytes() for k in unique]
        if len(self.known) + len(names) > MEMORY:
            self.known.clear()
        new = [i for i, name in enumerate(names) if name not in self.known]
        for i, found in zip(new, self._candidates(cells[first[new]])):
            self.known[names[i]] = found
        lists = [self.known[name] for name in names]
        sizes = np.array([len(x) for x in lists])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate(lists)
        # A line per part and candidate of its cell.
        count = sizes[inverse]
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])
        row = np.repeat(np.arange(len(parts)), count)
        entry = flat[np.arange(len(row)) - np.repeat(starts - begin[inverse], count)]
        distance = np.zeros(len(row), np.int64)
        for axis in range(parts.shape[1]):
            distance += (parts[:, axis].astype(np.int64)[row] - self.codebook[entry, axis]) ** 2
        self.evaluated += len(row)
        best = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == np.repeat(best, count))
        _, leader = np.unique(row[hit], return_index=True)
        return entry[hit[leader]], best


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("grid"))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _pieces(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[tuple]:
    """Batches with the index and distance of every part: two arrays of rows x parts."""
    caches = [CellCache(book) for book in codebooks]
    width = codebooks.shape[2]
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            grid = _matrix(batch)
            found = [cache.nearest(grid[:, p * width : (p + 1) * width]) for p, cache in enumerate(caches)]
            yield batch, grid, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _sums(codebooks: np.ndarray):
    """Per part, entry and position: sum and number of the components assigned, a row each for every task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = codebooks.shape
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for _, grid, index, _ in _pieces(batches, codebooks):
            for p in range(parts):
                np.add.at(total[p], index[:, p], grid[:, p * width : (p + 1) * width].astype(np.int64))
                count[p] += np.bincount(index[:, p], minlength=entries)
        p, e, i = (x.ravel() for x in np.indices(total.shape))
        used = count[p, e] > 0
        columns = [p[used], e[used], i[used], total.ravel()[used], count[p, e][used]]
        names = ["part", "entry", "position", "total", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    return work


def _codes(codebooks: np.ndarray, digest: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, index, distance in _pieces(batches, codebooks):
            text = [bytes(row).hex() for row in index.astype(np.uint8)]
            rest = [c for c, n in zip(batch.columns, batch.schema.names) if n != "grid"]
            names = [n for n in batch.schema.names if n != "grid"]
            new = [pa.array(text, pa.string()), pa.array(distance.sum(1)), pa.array([digest] * len(text), pa.string())]
            yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, "code", "error", "codebooks_sha256"])

    return work


def grid_vectors(vectors: DataFrame, id: str, vector: str, label: str, scratch: Scratch) -> DataFrame:
    """``id, label, grid`` of all vectors that are coded, written once."""
    picked = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in picked.schema if f.name != "vector"]
    kept = scratch.put("grid", picked.mapInArrow(_grid("vector"), ", ".join([*fields, "grid array<int>"])))
    first = kept.filter("id is not null").orderBy("id", "grid").select(F.size("grid").alias("n")).first()
    return kept.filter(F.size("grid") == (first.n if first else 0))


def seeds(grids: DataFrame) -> np.ndarray:
    """Codebooks of the parts of the vectors with the ``ENTRIES`` smallest ids: parts x entries x width."""
    ids = [r.id for r in grids.filter("id is not null").select("id").distinct().orderBy("id").limit(ENTRIES).collect()]
    if not ids:
        return np.zeros((PARTS, 0, 1), np.int64)
    # One vector an id, found map tasks first; at most ENTRIES rows reach the driver.
    rows = grids.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("grid").alias("grid")).orderBy("id").collect()
    whole = np.array([r.grid for r in rows], np.int64)
    return whole.reshape(len(rows), PARTS, -1).transpose(1, 0, 2)


def refined(grids: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry is the floored mean of the parts nearest to it."""
    found = grids.select("grid").mapInArrow(_sums(codebooks), "part long, entry long, position long, total long, n long")
    sums = found.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = codebooks.copy()
    for row in sums.collect():  # as many rows as the codebooks have components
        out[row.part, row.entry, row.position] = row.total // row.n
    return out


def vector_codes(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every vector, ids under their own name.

    Left out are vectors that are null, empty or cannot be cut into ``PARTS`` equal parts, that
    hold a null or a component that is not finite (or so large that squared distances would
    not fit a long), and those with another length than the vector of the smallest id.
    Codebooks start from the smallest ids, one vector each (the least one of an id that
    repeats), fewer than ``ENTRIES`` if there are no more; rows without an id are coded but
    start nothing, and if no row has an id nothing is coded. Repeated rows are coded each.
    ``label_error`` is the error summed over equal labels, rows without a label together. Of
    clashing column names only the three named ones are read.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    grids = grid_vectors(vectors, id, vector, label, scratch)
    codebooks = seeds(grids)
    if not codebooks.size:
        grids = grids.limit(0)
    for _ in range(ROUNDS if codebooks.size else 0):
        codebooks = refined(grids, codebooks)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    kinds = {f.name: f.dataType.simpleString() for f in grids.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long, codebooks_sha256 string"
    coded = scratch.put("codes", grids.mapInArrow(_codes(codebooks, digest), schema))
    scratch.drop("grid")
    return with_label_error(coded).select(F.col("id").alias(id), "code", "error", "label_error", "codebooks_sha256")


def with_label_error(coded: DataFrame, most: int = 1000) -> DataFrame:
    """``coded`` with ``label_error``. Labels that hold at least one in ``most`` rows, at most so many, are sent to all tasks."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    totals = totals.withColumnRenamed("label", "name")
    least = F.lit(coded.count() / most)
    hot, cold = totals.filter(F.col("n") >= least).drop("n"), totals.filter(F.col("n") < least).drop("n")
    same = F.col("label").eqNullSafe(F.col("name"))
    common = coded.join(F.broadcast(hot), same)
    rest = coded.join(F.broadcast(hot.select("name")), same, "left_anti").join(cold, same)
    return common.unionByName(rest).drop("name")
