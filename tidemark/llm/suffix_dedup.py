"""Suffix-array dedup: bytes of passages that occur twice anywhere are removed.

A byte goes if some string of ``PASSAGE`` bytes that covers it also starts elsewhere, judged on
the input. Windows are grouped by their content-defined anchor, so that only windows around
equal anchors are compared: their contexts are sorted by deep-shallow suffix sorting, from
the anchor on and mirrored before it, and windows are equal where both orders say so.

Texts are split nowhere and shuffled once; what moves besides is a few numbers per anchor
and, where equal anchors stand in different contexts, one copy of each context. A context
that stands twice goes whole; what is sorted answers for contexts that stand once, each of
which carries its place, so that no answer is dealt out to the anchors of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.anchors import GRAM, PASSAGE, anchors
from tidemark.llm.scratch import Scratch
from tidemark.llm.suffix_sort import shared_windows
from tidemark.llm.words import buffer, mix, slices

# Different contexts of one anchor that a task sorts at most; windows of larger groups are counted one by one.
GROUP = 5_000
# Contexts that are sorted at once.
BATCH = 30_000
# Grams that stand in several places which are sent to every task, some 20 bytes each; more are joined by shuffle.
BROADCAST_GRAMS = 1_000_000
# Anchors of one gram that a task joins at most by shuffle.
HOT_ROWS = 200_000

_KEYS = ["t", "tag"]


def _text_key() -> list[Column]:
    """Two hashes that stand for a text; together 79 bits."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("t"), F.pmod(F.xxhash64(text, F.lit(1)), F.lit(1 << 15)).alias("tag")]


def _packed(at: np.ndarray, left: np.ndarray, size: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Place of an anchor, reach and size of its context and the text's second hash in 63 bits."""
    return (tag << 48) | (at << 17) | (left << 9) | size


def _tag() -> Column:
    return F.shiftrightunsigned("place", 48).alias("tag")


def _span() -> tuple[Column, Column]:
    """Start and size of the context of ``place``."""
    at = F.shiftrightunsigned("place", 17).bitwiseAND(F.lit((1 << 31) - 1))
    return at - F.shiftrightunsigned("place", 9).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(511))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per anchor: text, place, hash of the gram and hash of the context.

    What counts is whether something occurs once or again, so of equal texts a task sends the
    anchors of two: a text that fills a third of the corpus costs no more than two a task.
    """
    seen: dict[tuple[int, int], int] = {}
    for piece in slices(batches, "text"):
        t, tag = (piece.column(c).to_numpy(zero_copy_only=False) for c in _KEYS)
        keep = []
        for key in zip(t.tolist(), tag.tolist()):
            seen[key] = seen.get(key, 0) + 1
            keep.append(seen[key] <= 2)
        piece = piece.filter(pa.array(keep))
        t, tag = t[keep], tag[keep]
        data, offsets = buffer(piece.column("text"))
        hashed, at, start, end, owner = anchors(data, offsets)
        gram = hashed.spans(at, at + GRAM)
        context = hashed.spans(start, end) ^ mix((at - start).astype(np.uint64))
        place = _packed(at - offsets[owner], at - start, end - start, tag[owner])
        columns = [pa.array(x) for x in (t[owner], place, gram.view(np.int64), context.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["t", "place", "gram", "context"])


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the contexts that are wanted of each text."""
    for batch in batches:
        for k in range(batch.num_rows):
            text = batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
            wanted = batch.column("wanted")[k].as_py()
            t, rows = batch.column("t")[k].as_py(), []
            for w in wanted:
                at, left, size = w["place"] >> 17 & (1 << 31) - 1, w["place"] >> 9 & 255, w["place"] & 511
                rows.append((w["gram"], t, w["place"], w["n"], text[at - left : at - left + size]))
            names, kinds = ("gram", "t", "place", "n", "bytes"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=list(names))


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of each context that stands once; rows come ordered by gram, so groups are whole."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        contexts = table.column("bytes").to_pylist()
        t, place, counts, gram = (table.column(c).to_numpy() for c in ("t", "place", "n", "gram"))
        first, last = shared_windows(contexts, place >> 9 & 255, counts, gram, PASSAGE)
        hit = (first >= 0) & (counts == 1)
        columns = [pa.array(x[hit]) for x in (t, place, first, last + PASSAGE)]
        return pa.RecordBatch.from_arrays(columns, names=["t", "place", "first", "last"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= BATCH:
            table = pa.Table.from_batches(waiting).combine_chunks()
            gram = table.column("gram").to_numpy()
            cut = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if gram[0] != gram[-1] else 0
            if cut:
                yield solve(table.slice(0, cut))
            waiting = table.slice(cut).to_batches()
    if waiting:
        yield solve(pa.Table.from_batches(waiting).combine_chunks())


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per window of a context, for groups too large to sort in one task."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            piece = batch.slice(k, 256)
            rows = []
            for gram, t, place, n, raw in zip(*(piece.column(c).to_pylist() for c in ("gram", "t", "place", "n", "bytes"))):
                left = place >> 9 & 255
                for start in range(max(0, len(raw) - PASSAGE + 1)):
                    digest = hashlib.blake2b(raw[start : start + PASSAGE], digest_size=16).digest()
                    rows.append((gram, t, place, n, start, left - start, digest))
            kinds = (pa.int64(),) * 6 + (pa.binary(),)
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "t", "place", "n", "start", "before", "window"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans as maximal runs, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _again(found: DataFrame, scratch: Scratch, few: int = BROADCAST_GRAMS, hot: int = HOT_ROWS) -> DataFrame:
    """Anchors whose gram stands in several places, and whether its contexts differ (``mixed``).

    ``found`` is a written table. Its grams are counted, map tasks first, and those that repeat
    are written; up to ``few`` of them are sent to every task. Beyond that both sides are
    shuffled, and a gram with more than ``hot`` rows goes to as many tasks as its count asks for,
    each with the gram's one count row.
    """
    counts = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    counts = scratch.put("grams", counts.filter("n > 1").select("gram", "n", (F.col("low") != F.col("high")).alias("mixed")))
    fields = ["t", "place", "gram", "context", "mixed"]
    if counts.count() <= few:
        return found.join(F.broadcast(counts.drop("n")), "gram").select(*fields)
    spread = counts.withColumn("parts", F.ceil(F.col("n") / hot))
    # At most one in ``hot`` rows of the table is a hot gram's first.
    many = spread.filter("parts > 1").select("gram", "parts")
    part = F.pmod(F.xxhash64("t", "place"), F.coalesce("parts", F.lit(1))).alias("part")
    dealt = found.join(F.broadcast(many), "gram", "left").select("t", "place", "gram", "context", part)
    one_each = spread.select("gram", "mixed", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    return dealt.join(one_each, ["gram", "part"]).select(*fields)


def repeated_spans(documents: DataFrame) -> DataFrame:
    """Per text with repeats: ``t, tag`` and ``spans``, where each span is one or more repeated windows."""
    keyed = documents.select(F.coalesce("text", F.lit("")).alias("text"), *_text_key())
    scratch = Scratch(documents.sparkSession, "repeats")
    found = keyed.filter(F.octet_length("text") >= PASSAGE).mapInArrow(_anchor_rows, "t long, place long, gram long, context long")
    again = scratch.put("again", _again(scratch.put("anchors", found), scratch))
    scratch.drop("anchors")
    scratch.drop("grams")
    kinds = again.filter("mixed").groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("t", "place")).alias("one"))
    kinds = scratch.put("kinds", kinds)
    wanted = (
        kinds.select("gram", "n", F.col("one.t").alias("t"), F.col("one.place").alias("place"))
        .groupBy("t", _tag())
        .agg(F.collect_list(F.struct("gram", "n", "place")).alias("wanted"))
    )
    texts = keyed.dropDuplicates(_KEYS).select("text", *_KEYS)
    contexts = texts.join(wanted, _KEYS).select("text", "t", "wanted")
    contexts = contexts.mapInArrow(_context_rows, "gram long, t long, place long, n long, bytes binary")
    contexts = scratch.put("contexts", contexts)
    large = contexts.groupBy("gram").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > GROUP).select("gram")
    small = contexts.join(large, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    hits = small.mapInArrow(_sorted_groups, "t long, place long, first long, last long")
    windows = contexts.join(large, "gram", "left_semi").mapInArrow(
        _window_rows, "gram long, t long, place long, n long, start long, before long, window binary"
    )
    same = ["gram", "before", "window"]
    often = windows.groupBy(*same).agg(F.sum("n").alias("total")).filter("total > 1").select(*same)
    hits = hits.unionByName(
        windows.filter("n = 1")
        .join(often, same)
        .groupBy("t", "place")
        .agg(F.min("start").alias("first"), (F.max("start") + PASSAGE).alias("last"))
    )
    start, size = _span()
    whole = _whole_contexts(again, kinds.filter("n > 1").select("gram", "context")).select("t", _tag(), start.alias("a"), (start + size).alias("b"))
    partly = hits.select("t", _tag(), (start + F.col("first")).alias("a"), (start + F.col("last")).alias("b"))
    # equal texts name equal spans, which a set holds once
    return whole.unionByName(partly).groupBy("t", "tag").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _whole_contexts(again: DataFrame, repeated: DataFrame, few: int = BROADCAST_GRAMS) -> DataFrame:
    """Anchors whose whole context stands elsewhere: all of a gram with one context, and those of ``repeated`` contexts.

    Nothing has to be sorted for them. Up to ``few`` repeated contexts are sent to every task,
    which reads the anchors once; more are joined by shuffle, without the anchors that need no answer.
    """
    on, fields = ["gram", "context"], ["t", "place"]
    if repeated.count() <= few:
        known = again.join(F.broadcast(repeated.withColumn("known", F.lit(True))), on, "left")
        return known.filter("not mixed or known").select(*fields)
    return again.filter("not mixed").select(*fields).unionByName(again.filter("mixed").join(repeated, on, "left_semi").select(*fields))


def _kept(text: bytes, runs: list[tuple[int, int]]) -> list[bytes]:
    """What is left of a text before, between and behind the runs that go."""
    edges = [0, *(x for run in runs for x in run), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


def _whole(rest: list[bytes]) -> str:
    return "".join(part.decode("utf-8", "ignore") for part in rest)


def _rests(text: pa.Array, repeats: pa.Array) -> pa.Array:
    """The characters that stay of each text; null where nothing repeats."""
    out = []
    for k in range(len(text)):
        spans = repeats[k].as_py()
        if spans is None:
            out.append(None)
            continue
        raw = (text[k].as_py() or "").encode("utf-8", "surrogatepass")
        out.append(_whole(_kept(raw, merged([(s["a"], s["b"]) for s in spans]))))
    return pa.array(out, pa.string())


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed bytes and runs of each text, and the digest of what is left."""
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            text = batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
            runs = merged([(s["a"], s["b"]) for s in batch.column("spans")[k].as_py()])
            gone = sum(b - a for a, b in runs)
            digest = hashlib.sha256(b"".join(_kept(text, runs))).hexdigest()
            rows.append((batch.column("t")[k].as_py(), batch.column("tag")[k].as_py(), gone, len(runs), digest))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=["t", "tag", "n_removed", "n_spans", "kept_sha256"])


def _changed(documents: DataFrame) -> DataFrame:
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"), *_text_key()).dropDuplicates(_KEYS).select("text", *_KEYS)
    joined = texts.join(repeated_spans(documents), _KEYS).select("text", "t", "tag", "spans")
    return joined.mapInArrow(_cut_rows, "t long, tag long, n_removed long, n_spans long, kept_sha256 string")


def passage_digests(documents: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of the bytes that stay.

    A null text counts as empty. Rows that repeat a text count as its copies: if it is long
    enough, all of it goes from all of them. Repeated rows give a row each; other columns are
    ignored.
    """
    text = F.coalesce("text", F.lit(""))
    own = documents.select("doc_id", *_text_key(), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    return own.join(_changed(documents), _KEYS, "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents, all columns and rows kept, with repeated passages cut out of ``text``.

    A character that loses some of its bytes goes as a whole, so that texts stay valid; a text
    may become empty. A null text stays null, a column ``n_chars`` follows the text, and other
    columns are left alone.
    """
    spans = repeated_spans(documents).select(*_KEYS, F.col("spans").alias("repeats"))
    names = {c: F.col(f"documents.`{c}`") for c in documents.columns}
    joined = documents.withColumns(dict(zip(_HIDDEN, _text_key()))).alias("documents")
    joined = joined.join(spans.alias("found"), (F.col(_HIDDEN[0]) == F.col("found.t")) & (F.col(_HIDDEN[1]) == F.col("found.tag")), "left")
    # The text itself is sent to Python only where something goes.
    hit = F.col("found.repeats").isNotNull()
    rest = F.arrow_udf(_rests, "string")(F.when(hit, names["text"]), "found.repeats")
    names["text"] = F.coalesce(rest, names["text"]).alias("text")
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        names["n_chars"] = F.when(hit, F.length(rest).cast(kind)).otherwise(names["n_chars"]).alias("n_chars")
    return joined.select(*names.values())


# Names that the key of a text has beside the columns of a caller.
_HIDDEN = ("__text_hash", "__text_tag")
