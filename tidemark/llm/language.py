"""Language identification, words first, then ever shorter character n-grams.

Every word of the learned texts is counted by language. A text's word that is known scores
the logarithm of its frequency in each language; an unseen one falls back to its longest
character n-grams of which any is known, and scores their mean. A text's language is the one
with the best mean over its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import between, buffer, mix, prefixes, slices, spans

UNKNOWN = "und"
# Longest n-gram that an unseen word falls back to.
LONGEST = 5
# Bounds of the model, which is sent to all tasks: languages (the most frequent ones), words and n-grams
# (those from a frequency on), and cells, a cell for each word or n-gram and language.
LANGUAGES = 1_000
WORDS = 200_000
GRAMS = 200_000
CELLS = 4_000_000
# Bytes of text whose words are counted together.
COUNTED_BYTES = 8 << 20

# Bytes of words: ASCII letters and all of other scripts.
WORD = np.zeros(256, bool)
WORD[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Code points that stand before and behind a word in its n-grams.
BEGIN, END = 1, 2


@dataclass(frozen=True)
class Model:
    """Scores of known words and n-grams: rows of ``languages`` columns, by sorted hash; ``usual`` is the fallback."""

    languages: tuple[str, ...]
    usual: int
    usual_share: float
    words: np.ndarray
    word_scores: np.ndarray
    grams: np.ndarray
    gram_scores: np.ndarray


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.fill_null(""))


def _word_spans(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes of the lower-cased texts; hash, text number, start and end of each word."""
    data, offsets = buffer(_lowered(texts))
    starts, ends, owner = spans(data, offsets, WORD)
    return data, between(prefixes(data), starts, ends), owner, starts, ends


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at the given spans."""
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], length)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, hash, n`` of each piece of a task's texts."""
    for piece in slices(batches, "text", COUNTED_BYTES):
        data, hashes, owner, starts, ends = _word_spans(piece.column("text"))
        if not len(hashes):
            continue
        names = piece.column("lang").dictionary_encode()
        lang = names.indices.to_numpy(zero_copy_only=False)[owner]
        _, first, n = np.unique(mix(hashes + lang.astype(np.uint64)), return_index=True, return_counts=True)
        columns = [names.dictionary.take(pa.array(lang[first])), _strings(data, starts[first], ends[first]).cast(pa.string())]
        columns += [pa.array(hashes[first].view(np.int64)), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "hash", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, hash, n`` over all rows of ``texts`` (text, lang); both must not be null."""
    found = texts.select("text", "lang").mapInArrow(_counted, "lang string, word string, hash long, n long")
    return found.groupBy("lang", "word").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))


def gram_hashes(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of ``size`` characters of the words, each word between its marks, and whose they are."""
    data, offsets = buffer(words)
    length = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = np.diff(length) + 2
    ends = np.cumsum(n)
    marked = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    inside = np.ones(len(marked), bool)
    inside[ends - n] = inside[ends - 1] = False
    marked[ends - n], marked[ends - 1], marked[inside] = BEGIN, END, points
    owner = np.repeat(np.arange(len(n)), n)
    if len(marked) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = owner[: len(owner) - size + 1] == owner[size - 1 :]
    hashes = np.full(int(whole.sum()), size, np.uint64)
    for k in range(size):
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + marked[k : len(marked) - size + 1 + k][whole])
    return hashes, owner[: len(whole)][whole]


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``size, lang, hash, n``: n-grams of the words of each batch, as often as their words occur."""
    for batch in batches:
        names = batch.column("lang").dictionary_encode()
        lang = names.indices.to_numpy(zero_copy_only=False)
        weight = batch.column("n").to_numpy(zero_copy_only=False)
        for size in range(1, LONGEST + 1):
            hashes, owner = gram_hashes(batch.column("word"), size)
            if not len(hashes):
                continue
            _, first, inverse = np.unique(mix(hashes + lang[owner].astype(np.uint64)), return_index=True, return_inverse=True)
            n = np.zeros(len(first), np.int64)
            np.add.at(n, inverse, weight[owner])
            columns = [pa.array(np.full(len(first), size, np.int32)), names.dictionary.take(pa.array(lang[owner[first]]))]
            columns += [pa.array(hashes[first].view(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "lang", "hash", "n"])


def _scale() -> Column:
    return F.floor(F.log2("n") * 16).cast("int")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` (hash, n) of at most ``most`` hashes: all whose total reaches a frequency.

    The frequency is found on a scale of sixteen steps an octave, so that no row is sorted.
    """
    totals = counts.groupBy("hash").agg(F.sum("n").alias("n"))
    steps = totals.groupBy(_scale().alias("step")).agg(F.count("*").alias("n")).collect()  # at most 1,024 rows
    least, room = 1 << 20, most
    for row in sorted(steps, key=lambda r: -r.step):
        room -= row.n
        if room < 0:
            break
        least = row.step
    return counts.join(totals.filter(_scale() >= least).select("hash"), "hash", "left_semi")


def _table(rows: pa.Table, languages: list[str], totals: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the logarithm of each one's frequency in every language; ``floor`` where it does not occur."""
    found, at = np.unique(rows["hash"].to_numpy().view(np.uint64), return_inverse=True)
    n = np.zeros((len(found), len(languages)))
    lang = pc.index_in(rows["lang"], pa.array(languages, pa.string())).to_numpy()
    np.add.at(n, (at, lang.astype(np.int64)), rows["n"].to_numpy())
    with np.errstate(divide="ignore"):
        return found, np.maximum(np.log(n / totals), floor).astype(np.float32)


def train(texts: DataFrame, scratch: Scratch) -> Model:
    """A model of all rows of ``texts`` (text, lang), neither null. What reaches the driver is bounded by the constants above."""
    counts = scratch.put("words", word_counts(texts))
    per_language = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    per_language.sort(key=lambda r: r.lang)
    languages, totals = [r.lang for r in per_language], np.array([r.n for r in per_language], float)
    if not languages:
        empty = np.zeros(0, np.uint64), np.zeros((0, 0), np.float32)
        return Model((), 0, 0.0, *empty, *empty)
    learned = counts.filter(F.col("lang").isin(languages))
    room = CELLS // len(languages)
    # The same for every language: half an occurrence in the largest of them.
    known = most_frequent(learned, min(WORDS, room)).select("lang", "hash", "n")
    words = _table(known.toArrow(), languages, totals, np.log(0.5 / totals.max()))
    grams = learned.mapInArrow(_grams, "size int, lang string, hash long, n long").groupBy("size", "lang", "hash").agg(F.sum("n").alias("n"))
    grams = scratch.put("grams", grams)
    by_size = {(r["size"], r.lang): r.n for r in grams.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    kept = most_frequent(grams, min(GRAMS, room)).select("size", "lang", "hash", "n").toArrow()
    scratch.drop("words")
    scratch.drop("grams")
    tables = []
    for size in range(1, LONGEST + 1):
        own = np.array([by_size.get((size, name), 1) for name in languages], float)
        tables.append(_table(kept.filter(pc.equal(kept["size"], size)), languages, own, np.log(0.5 / own.max())))
    hashes = np.concatenate([t[0] for t in tables])
    order = np.argsort(hashes)
    scores = np.concatenate([t[1] for t in tables])[order]
    usual = int(np.argmax(totals))
    return Model(tuple(languages), usual, float(totals[usual] / totals.sum()), *words, hashes[order], scores)


def _found(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash in a sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def backed_off(words: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores of unseen words: the mean over the known n-grams of the greatest size that has any; and which have none at all."""
    scores = np.zeros((len(words), len(model.languages)))
    left = np.arange(len(words))
    for size in range(LONGEST, 0, -1):
        if not len(left):
            break
        hashes, owner = gram_hashes(words.take(pa.array(left)), size)
        at = _found(model.grams, hashes)
        owner, at = owner[at >= 0], at[at >= 0]
        if len(at):
            hit, first, n = np.unique(owner, return_index=True, return_counts=True)
            scores[left[hit]] = np.add.reduceat(model.gram_scores[at].astype(np.float64), first, axis=0) / n[:, None]
            left = np.delete(left, hit)
    nothing = np.zeros(len(words), bool)
    nothing[left] = True
    return scores, nothing


def text_scores(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per text and language the mean score of its words, and the number of words that have one."""
    data, hashes, owner, starts, ends = _word_spans(texts)
    at = _found(model.words, hashes)
    unseen = np.flatnonzero(at < 0)
    _, first, which = np.unique(hashes[unseen], return_index=True, return_inverse=True)
    spelled = _strings(data, starts[unseen[first]], ends[unseen[first]])
    scores, nothing = backed_off(spelled, model)
    counts = np.zeros(len(texts), np.int64)
    total = np.zeros((len(texts), len(model.languages)))
    for of, table, row in ((at >= 0, model.word_scores, at), (at < 0, scores, None)):
        index = np.flatnonzero(of)
        row = at[index] if row is not None else which
        if row is which:
            index, row = index[~nothing[which]], which[~nothing[which]]
        if not len(index):
            continue
        text, begin, n = np.unique(owner[index], return_index=True, return_counts=True)
        total[text] += np.add.reduceat(table[row].astype(np.float64), begin, axis=0)
        counts[text] += n
    return total / np.maximum(counts, 1)[:, None], counts


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``; only ``text`` is looked at."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for piece in slices(batches, "text"):
            texts = piece.column("text").fill_null("")
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
            best = np.full(len(texts), len(model.languages))
            score = np.zeros(len(texts))
            if model.languages:
                means, counts = text_scores(texts, model)
                share = 1 / np.exp(means - means.max(1)[:, None]).sum(1)
                best = np.where(counts > 0, means.argmax(1), model.usual)
                score = np.where(counts > 0, share, model.usual_share)
                best[~letters], score[~letters] = len(model.languages), 0.0
            new = [pa.array(names[best], pa.string()), pa.array(score)]
            rest = [c for c, n in zip(piece.columns, piece.schema.names) if n != "text"]
            kept = [n for n in piece.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, *new], names=[*kept, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != "text"]
    return documents.mapInArrow(work, ", ".join([*fields, "lang_pred string", "score double"]))


def languages(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``documents`` (doc_id, text, lang).

    Learned are the rows with text and ``lang`` whose id, hashed, leaves a remainder other than
    2; a row without an id is neither learned nor held out. Repeated rows count each. A null
    text, or one without a letter, is ``und`` with score 0; so is everything if nothing was
    learned. A text with letters of which no word or n-gram is known gets the language with most words. Of
    languages that score the same the first by name is taken. Columns with clashing names are not read.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    rows = documents.select("doc_id", "text", "lang", fold.alias("fold"))
    model = train(rows.filter("fold != 2 and text is not null and lang is not null").select("text", "lang"), Scratch(documents.sparkSession, "language"))
    held = F.coalesce(F.col("fold") == 2, F.lit(False)).alias("held_out")
    return predict(rows.select("doc_id", held, "text"), model)
