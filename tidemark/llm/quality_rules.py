"""Quality rules: counts of each text against fixed bounds, then a calibrated n-gram classifier.

Hashed word and character n-grams feed a logistic regression that is fitted on a bounded
sample of labelled rows and calibrated on rows it was not fitted on; every text is then
scored whole in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import NOT_SPACE, between, buffer, mix, per_text, prefixes, slices, spans, windows

# Labelled rows the model is fitted on at most; every row is scored.
SAMPLE_ROWS = 2000
# Longest text drawn for the sample, in characters.
SAMPLE_CHARS = 200_000
# Hash bins of each family of n-grams: words, pairs of words, 3 and 4 bytes.
BINS = 1 << 14
FAMILIES = 4
THRESHOLD = 0.5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The fixed counts of every text in the buffer."""
    n = len(offsets) - 1
    starts, ends, owner = spans(data, offsets, NOT_SPACE)
    running = prefixes(data)
    seed = mix(np.arange(n, dtype=np.uint64) + np.uint64(77))
    hashes = between(running, starts, ends)
    counts = {"n_words": np.bincount(owner, minlength=n).astype(np.int64)}
    counts["word_chars"] = per_text(NOT_SPACE[data] & (data & 0xC0 != 0x80), offsets)
    counts["n_symbols"] = per_text(_SYMBOLS[data], offsets)

    line_start, line_end, line_owner = spans(data, offsets, np.arange(256) != 10)
    inside = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    # A word never spans lines, so a line holds a word if one starts in it.
    line_start, line_end, line_owner = line_start[inside], line_end[inside], line_owner[inside]
    _, kept = np.unique(between(running, line_start, line_end) ^ seed[line_owner], return_index=True)
    counts["n_dup_lines"] = (np.bincount(line_owner, minlength=n) - np.bincount(line_owner[kept], minlength=n)).astype(np.int64)

    five, at = windows(hashes, owner, 5)
    _, back, often = np.unique(five ^ seed[owner[at]], return_inverse=True, return_counts=True)
    again = at[often[back] > 1]
    change = np.zeros(len(starts) + 5, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + 5, -1)
    covered = np.cumsum(change)[: len(starts)] > 0
    counts["n_repeat_words"] = np.bincount(owner[covered], minlength=n).astype(np.int64)
    return counts


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per family: hash bins of all n-grams and the text each belongs to."""
    starts, ends, owner = spans(data, offsets, NOT_SPACE)
    hashes = between(prefixes(data), starts, ends)
    shift = np.uint64(64 - 14)
    yield (hashes >> shift).astype(np.int32), owner
    pairs, at = windows(hashes, owner, 2)
    yield (pairs >> shift).astype(np.int32), owner[at]
    whose = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = data.astype(np.uint32)
    for size in (3, 4):
        if len(code) < size:
            yield np.zeros(0, np.int32), np.zeros(0, np.int64)
            continue
        gram = code[: len(code) - size + 1].copy()
        for k in range(1, size):
            gram |= code[k : len(code) - size + 1 + k] << np.uint32(8 * k)
        same = whose[: len(gram)] == whose[size - 1 :]
        bins = (gram * np.uint32(2654435761)) >> np.uint32(32 - 14)
        yield bins[same].astype(np.int32), whose[: len(gram)][same]


def linear(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over the families of the mean weight of a text's n-grams."""
    n = len(offsets) - 1
    total = np.zeros(n)
    for k, (bins, owner) in enumerate(ngrams(data, offsets)):
        table = weights[k * BINS : (k + 1) * BINS]
        total += np.bincount(owner, table[bins], n) / np.maximum(np.bincount(owner, minlength=n), 1)
    return total


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text"):
        data, offsets = buffer(piece.column("text"))
        n = len(offsets) - 1
        rows: list[list] = [[] for _ in range(n)]
        for k, (bins, owner) in enumerate(ngrams(data, offsets)):
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(n + 1))
            for i in range(n):
                found, count = np.unique(bins[order[cuts[i] : cuts[i + 1]]], return_counts=True)
                rows[i].append((found + k * BINS, count / max(count.sum(), 1)))
        index = [np.concatenate([f for f, _ in r]).astype(np.int32) for r in rows]
        share = [np.concatenate([s for _, s in r]).astype(np.float32) for r in rows]
        packed = [pa.array([x.tobytes() for x in column], pa.binary()) for column in (index, share)]
        yield pa.RecordBatch.from_arrays([piece.column("label").cast(pa.int32()), *packed], names=["label", "index", "share"])


def one_text_each(rows: DataFrame, *names: str) -> DataFrame:
    """One row per id and ``names``: the text with the least hash, so that an id that repeats counts once.

    A grouped minimum: each task sends a row per id at most, however often the id occurs.
    """
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return rows.groupBy("doc_id", *names).agg(least.alias("least")).select("doc_id", F.col("least.text").alias("text"), *names)


def marks(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, label`` of all labelled ids; rows without an id or label do not count, several labels are averaged."""
    rated = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return rated.groupBy("doc_id").agg((F.avg(column) >= 0.5).cast("int").alias("label"))


def labelled_sample(documents: DataFrame, labels: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents, those with the smallest hash of doc_id.

    Rows without an id or label do not count; several labels of one id are averaged, and of
    several texts of one id the one with the least hash is taken.
    """
    picked = marks(labels, column).orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(column)), "doc_id").limit(rows)
    # At most ``rows`` rows, so it can be sent to all executors.
    text = F.coalesce("text", F.lit("")).alias("text")
    texts = documents.select("doc_id", text).filter(F.length("text") <= SAMPLE_CHARS)
    return one_text_each(texts.join(F.broadcast(picked), "doc_id"), "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def platt(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid from margins to probabilities, with smoothed targets."""
    good = label.sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (len(label) - good + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * raw + shift)
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * raw).sum() + 1e-3 * (slope - 1), (p - target).sum()])
        h = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit(rows: list, steps: int = 60) -> tuple[np.ndarray, float, float] | None:
    """Weights, slope and shift; None without rows of both classes.

    Three of four rows fit the weights by gradient steps with momentum, the others the
    sigmoid. Features are scaled by their root mean square.
    """
    label = np.array([r["label"] for r in rows], np.float64)
    if len(set(label)) < 2:
        return None
    parts = [np.frombuffer(r["index"], np.int32) for r in rows]
    index = np.concatenate(parts)
    share = np.concatenate([np.frombuffer(r["share"], np.float32) for r in rows]).astype(np.float64)
    whose = np.repeat(np.arange(len(rows)), [len(x) for x in parts])
    fitted = np.arange(len(rows)) % 4 != 3
    if len(set(label[~fitted])) < 2 or len(set(label[fitted])) < 2:
        fitted[:] = True
    scale = 1 / np.sqrt(np.bincount(index, share**2, FAMILIES * BINS) / len(rows) + 1e-7)
    value = share * scale[index]
    norm = np.sqrt(np.bincount(whose, value**2, len(rows)).mean())
    value /= max(norm, 1e-9)
    balance = np.where(label > 0, 0.5 / label[fitted].mean(), 0.5 / (1 - label[fitted].mean())) * fitted
    weights, speed, bias = np.zeros(FAMILIES * BINS), np.zeros(FAMILIES * BINS), 0.0
    for _ in range(steps):
        raw = np.bincount(whose, value * weights[index], len(rows)) + bias
        slope = balance * (sigmoid(raw) - label) / fitted.sum()
        gradient = np.bincount(index, value * slope[whose], FAMILIES * BINS) + 1e-4 * weights
        speed = 0.9 * speed - 2.0 * gradient
        weights += speed
        bias -= 2.0 * slope.sum()
    raw = np.bincount(whose, value * weights[index], len(rows)) + bias
    rest = ~fitted if (~fitted).any() else fitted
    slope, shift = platt(raw[rest], label[rest])
    return (weights * scale / max(norm, 1e-9)).astype(np.float64), slope, shift + slope * bias


def quality_rules(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: fixed counts, both verdicts and the calibrated probability.

    A null text counts as empty and so fails the fixed rules. Repeated rows and ids are
    judged each on its own; other columns are ignored. Without labels of both classes
    ``probability`` is null and the fixed rules alone decide.
    """
    rows = labelled_sample(documents, labels, "quality", sample_rows).mapInArrow(
        _sample_features, "label int, index binary, share binary"
    )
    model = fit(sorted(rows.collect(), key=lambda r: (bytes(r["index"]), bytes(r["share"]))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            data, offsets = buffer(piece.column("text"))
            counts = base_counts(data, offsets)
            failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
            if model is None:
                kept, chance = ~failed, pa.nulls(len(failed), pa.float64())
            else:
                p = sigmoid(model[1] * linear(data, offsets, model[0]) + model[2])
                kept, chance = ~failed & (p >= threshold), pa.array(p)
            columns = [piece.column("doc_id"), *(pa.array(counts[k]) for k in COUNTS), pa.array(failed), pa.array(kept), chance]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept", "probability"])

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {kinds}, base_failed boolean, kept boolean, probability double"
    return documents.select("doc_id", "text").mapInArrow(score, schema)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
