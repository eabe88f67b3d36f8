"""Spelling variants: words one edit from a far more frequent word, found over a reduced alphabet.

Code points are hashed to a few symbols. One edit of a word is at most one edit of its reduced
form, so all one-edit neighbours of the reduced forms are generated and joined with the reduced
forms that occur; the few words behind a hit are compared as they are. Being near is mutual, so
each pair of reduced forms is generated from one of its two sides: the longer one by
deletions, of equal lengths the one with the lower symbol by replacements.

A reduced form that stands for too many words would make its words meet each other. Such words,
and those next to them, are taken to a larger alphabet instead, in the end to one in which
all letters of the words differ.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import mix, slices

# Runs of letters, fixed by the contract; a shorter one cannot leave a word.
RUN = re.compile("[a-zÀ-ÿ]{7,}")
LEAST_LETTERS = 7
LEAST_COUNT = 2
# A run whose hash this divides loses a code point.
DROP_ONE_IN = 31
# A form is so many times as frequent as its word.
RATIO = 10
# Sizes of the reduced alphabet, each a divisor of the next, so that crowds only fall apart; words whose reduced form is
# crowded go on to the next. The last one tells all letters of the words apart.
SYMBOLS = (8, 32, 256)
# Words that a reduced form may stand for, but at the last size.
CROWD = 64
# Different words that a task counts before it hands them on, and cells of a table of neighbours.
COUNTED = 300_000
CELLS = 1 << 21


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of a task's texts; a word may come more than once."""
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for piece in slices(batches, "text"):
        texts, ids = piece.column("text"), piece.column("id")
        for text, own in zip(texts, ids):
            if not text.is_valid:
                continue
            # Of bytes, lower() changes A to Z only.
            lowered = text.as_py().encode().lower().decode()
            start = zlib.crc32(f"{own.as_py() if own.is_valid else ''}:".encode())
            for run, n in Counter(RUN.findall(lowered)).items():
                hash = zlib.crc32(run.encode(), start)
                if hash % DROP_ONE_IN == 0:
                    at = hash % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST_LETTERS:
                        continue
                total[run] += n
        if len(total) > COUNTED:
            yield out()
            total.clear()
    yield out()


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts that occur often enough."""
    texts = documents.select(F.col("doc_id").cast("string").alias("id"), "text")
    found = texts.mapInArrow(_counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words back to back, and the word number of each."""
    texts = words.to_pylist()
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _place(n: int) -> np.ndarray:
    """An odd random factor for each of ``n`` places."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _key(sums: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return mix(sums + np.asarray(length, np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def reduced_keys(words: pa.Array, symbols: int) -> np.ndarray:
    """64-bit hashes of the reduced forms."""
    points, owner = _code_points(words)
    length = np.bincount(owner, minlength=len(words))
    at = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    values = (points % symbols + 1).astype(np.uint64) * _place(int(length.max(initial=0)))[at]
    running = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(length)
    return _key(running[ends] - running[ends - length], length)


def neighbours(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the reduced form itself, of all its one-letter deletions and of all replacements by a higher symbol.

    All words have the same length. Returns the word number and the hash of each.
    """
    size, n = len(words[0]), len(words)
    form = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size) % symbols
    place = _place(size)
    value = (form + 1).astype(np.uint64) * place
    whole = value.sum(1, dtype=np.uint64)
    # Deletion: what stands behind moves one place ahead. Within a run of equal symbols all give the same.
    moved = (form[:, 1:] + 1).astype(np.uint64) * place[:-1]
    before = np.cumsum(value, 1, dtype=np.uint64) - value
    behind = np.zeros_like(value)
    behind[:, :-1] = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
    first = np.ones(form.shape, bool)
    first[:, 1:] = form[:, 1:] != form[:, :-1]
    row, at = np.nonzero(first)
    rows, keys = [np.arange(n), row], [_key(whole, size), _key((before + behind)[row, at], size - 1)]
    # Replacement: each higher symbol at each place.
    step = np.arange(1, symbols, dtype=np.uint64)
    for at in range(size):
        row, up = np.nonzero(form[:, at, None] + step[None, :] < symbols)
        rows.append(row)
        keys.append(_key(whole[row] + step[up] * place[at], size))
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(symbols: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = reduced_keys(batch.column("word"), symbols)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])

    return work


def _generated(symbols: int):
    """Each reduced form (``home``, and whether it is crowded) with each of its neighbours (``near``), from one word of the form."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            homes = batch.column("key").to_numpy(zero_copy_only=False)
            many = batch.column("many").to_numpy(zero_copy_only=False)
            length = np.array([len(w) for w in words], np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                step = max(1, CELLS // (size * symbols))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    row, keys = neighbours([words[i] for i in some], symbols)
                    columns = [pa.array(homes[some[row]]), pa.array(many[some[row]].astype(bool)), pa.array(keys)]
                    yield pa.RecordBatch.from_arrays(columns, names=["home", "home_many", "near"])

    return work


def _verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Both directions of all pairs of words one edit apart, among the words of pairs of reduced forms."""
    left = members.select(F.col("key").alias("home"), F.col("word").alias("a"), F.col("n").alias("an"))
    right = members.select(F.col("key").alias("near"), F.col("word").alias("b"), F.col("n").alias("bn"))
    met = pairs.join(left, "home").join(right, "near")
    # Within one reduced form each pair comes twice; of two forms once.
    once = (F.col("home") != F.col("near")) | (F.col("a") < F.col("b"))
    found = met.filter(once & (F.levenshtein("a", "b", 1) == 1))
    there = F.struct(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("other"), F.col("bn").alias("other_n"))
    back = F.struct(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("other"), F.col("an").alias("other_n"))
    return found.select(F.inline(F.array(there, back)))


def near_words(words: DataFrame, scratch: Scratch, symbols: tuple[int, ...] = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, n, other, other_n`` for all words of ``words`` (word, n) that differ by one edit, in both directions.

    At each size of the alphabet the pairs are done whose reduced forms are both uncrowded; a
    pair with a crowded one is left to the next size, where both of its words are.
    """
    found = None
    todo = words.withColumn("crowded", F.lit(True))  # ``crowded``: at the size before
    for level, size in enumerate(symbols):
        last = level == len(symbols) - 1
        members = scratch.put(f"members{level}", todo.mapInArrow(_keyed(size), "word string, n long, crowded boolean, key long"))
        forms = members.groupBy("key").agg(F.count("*").alias("m"), F.min("word").alias("word"))
        forms = forms.select("key", "word", (F.lit(not last) & (F.col("m") > crowd)).alias("many"))
        near = forms.mapInArrow(_generated(size), "home long, home_many boolean, near long")
        there = forms.select(F.col("key").alias("near"), "many")
        pairs = near.join(there, "near").select("home", "near", (F.col("home_many") | F.col("many")).alias("full"))
        pairs = scratch.put(f"pairs{level}", pairs)
        some = _verified(pairs.filter(~F.col("full")), members)
        # A pair of words of which neither was crowded at the size before is done already.
        if level:
            some = _with_crowded(some, members)
        some = scratch.put(f"near{level}", some)
        found = some if found is None else found.unionByName(some)
        if last or pairs.filter("full").isEmpty():
            break
        full = pairs.filter("full").select(F.explode(F.array("home", "near")).alias("key")).distinct()
        todo = members.join(full, "key", "left_semi").join(forms.select("key", "many"), "key")
        todo = todo.select("word", "n", F.col("many").alias("crowded"))
    return found


def _with_crowded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs with at least one word that was crowded at the size before."""
    crowded = members.filter("crowded").select("word")
    first = pairs.join(crowded, "word", "left_semi")
    rest = pairs.join(crowded, "word", "left_anti")
    return first.unionByName(rest.join(crowded.withColumnRenamed("word", "other"), "other", "left_semi"))


def with_roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` for all rows of ``forms`` (word, form): the last word on the way over the forms.

    Each step multiplies the count by at least ``RATIO``, so no way is longer than the logarithm
    of the largest count, ``most``; every round doubles the steps taken.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while RATIO**steps * LEAST_COUNT <= most:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        steps *= 2
    return roots


def spelling_variants(documents: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts of ``documents``.

    Words are counted over all texts; a null text has none, a row without an id hashes its
    runs with an empty one, repeated rows count each. Of near words that are equally
    frequent the first in code-point order is the form. Very long runs are words like others. An
    empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    scratch = Scratch(documents.sparkSession, "spelling")
    words = scratch.put("words", vocabulary(documents))
    near = near_words(words, scratch)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best = scratch.put("best", best.select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.other").alias("best")))
    named = words.join(best, "word", "left")
    far = F.col("best_n") >= RATIO * F.col("n")
    named = named.select(
        "word", F.when(far, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(far, F.col("best_n")).alias("form_n")
    )
    named = scratch.put("named", named)
    most = named.agg(F.max("n")).first()[0] or 0
    roots = with_roots(named.filter("form is not null"), most)
    out = named.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
