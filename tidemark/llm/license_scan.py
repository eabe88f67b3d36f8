"""Licence scan: short notices found exactly and with a bounded number of edits.

A notice of n edits is split into n + 1 pieces; whatever text holds it with at most n edits
holds one piece unchanged (pigeonhole). Pieces are searched as plain substrings, and only
windows around their hits go to the ``regex`` library, whose bounded-error match decides.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed by the contract: phrases whose words stand consecutively, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices searched with edits, their labels and how many edits they may have.
NOTICES = {
    "under the mit license": ("mit", 2),
    "apache license version 2": ("apache-2", 2),
    "cc by nc 4 0": ("cc-by-nc", 0),
    "creative commons attribution noncommercial": ("cc-by-nc", 3),
    "creative commons attribution sharealike": ("cc-by-sa", 3),
    "gnu general public license": ("gpl", 2),
    "gnu lesser general public license": ("lgpl", 2),
    "gnu affero general public license": ("agpl", 2),
    "mozilla public license": ("mpl", 2),
    "bsd 3 clause license": ("bsd", 2),
    "permission is hereby granted free of charge": ("mit", 3),
    "redistribution and use in source and binary forms": ("bsd", 3),
    "all rights reserved": ("all-rights-reserved", 1),
}

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normalized(text: str) -> bytes:
    """Lower-cased words, one space between, before and after them."""
    return b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()) + b" "


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """``edits + 1`` pieces of nearly equal length and where each starts."""
    raw, n = notice.encode(), edits + 1
    cuts = [len(raw) * k // n for k in range(n + 1)]
    return [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds all notices of one catalogue in a text."""

    def __init__(self, notices: dict[str, tuple[str, int]] = NOTICES, phrases: dict[str, str] = BASE_PHRASES):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.notices = [
            (p, label, edits, pieces(p, edits), regex.compile(rb"(?b)(?: " + p.encode() + rb" ){e<=%d}" % edits))
            for p, (label, edits) in notices.items()
        ]

    def exact(self, text: bytes) -> list[tuple[int, str]]:
        """Byte offset and label of every place where a phrase's words stand; places may overlap."""
        found = []
        for phrase, label in self.phrases:
            at = text.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = text.find(phrase, at + 1)
        return found

    def fuzzy(self, text: bytes) -> list[tuple[int, int, str, int, int]]:
        """Start, end, label, edits and length of each notice found with bounded edits.

        Places of one notice share at most the space between them. Where several compete, the
        one with the fewest edits is taken, then the first.
        """
        found = []
        for notice, label, edits, parts, pattern in self.notices:
            windows = self._windows(text, parts, len(notice), edits)
            found += [(a, b, label, e, len(notice)) for a, b, e in self._places(text, pattern, windows, len(notice) + 2 - edits)]
        return found

    @staticmethod
    def _windows(text: bytes, parts: list[tuple[int, bytes]], size: int, edits: int) -> set[tuple[int, int]]:
        """A window for each hit of a notice's pieces, which holds all the text that the notice can take up there."""
        hits = set()
        for start, part in parts:
            at = text.find(part)
            while at >= 0:
                hits.add((max(0, at - start - edits - 1), min(len(text), at - start + size + edits + 2)))
                at = text.find(part, at + 1)
        return hits

    @staticmethod
    def _places(text: bytes, pattern: regex.Pattern, windows: set[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
        """Start, end and edits of the places taken, in order; ``least`` is the shortest that one can be."""
        waiting: list[tuple[int, int, int, int, int]] = []

        def look(low: int, high: int) -> None:
            hit = pattern.search(text, low, high) if high - low >= max(least, 2) else None
            if hit:
                heapq.heappush(waiting, (sum(hit.fuzzy_counts), hit.start(), hit.end(), low, high))

        for low, high in windows:
            look(low, high)
        taken: list[tuple[int, int, int]] = []
        while waiting:
            edits, start, end, low, high = heapq.heappop(waiting)
            k = bisect.bisect_left(taken, (start, end))
            near = [(a, b) for a, b, _ in taken[max(k - 1, 0) : k + 1] if min(b, end) - max(a, start) > 1]
            if not near:
                taken.insert(k, (start, end, edits))
            # the window may hold other places on either side of what is taken
            a, b = near[0] if near else (start, end)
            look(low, min(a + 1, high))
            look(max(b - 1, low), high)
        return taken

    def scan(self, text: str | None) -> dict:
        """Counts, labels, score and spans (in words) of one text."""
        flat = normalized(text or "")
        exact = self.exact(flat)
        fuzzy = self.fuzzy(flat)
        n_words = flat.count(b" ") - 1 if len(flat) > 2 else 0
        starts = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32) + 1 if exact or fuzzy else None
        word = lambda at: int(np.searchsorted(starts, at))
        places = [word(at + 1) for at, _ in exact]
        base = sorted({label for _, label in exact})
        spans = [(label, word(a + 1), max(word(a + 1) + 1, word(b - 1)), e) for a, b, label, e, _ in fuzzy]
        score = max([1.0] * bool(exact) + [1 - e / size for *_, e, size in fuzzy], default=0.0)
        return {
            "n_words": n_words,
            "n_base": len(exact),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(base),
            "labels": ",".join(sorted({*base, *(s[0] for s in spans)})),
            "score": score,
            "spans": [{"label": s[0], "start": s[1], "end": s[2], "edits": s[3]} for s in sorted(spans, key=lambda s: (s[1], s[0]))],
        }


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))
_KINDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": _SPANS,
}
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, start: long, end: long, edits: long>>"
)


def license_scan(documents: DataFrame, notices: dict[str, tuple[str, int]] = NOTICES) -> DataFrame:
    """One row per document: base counts, labels, score and the spans of notices in words.

    A null or empty text has no words, no labels and score 0. Repeated rows give a row each;
    other columns are ignored. ``score`` is 1 for an exact phrase, else the largest share of
    a notice that stands unedited.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                rows = [scanner.scan(text.as_py()) for text in piece.column("text")]
                columns = [pa.array([r[name] for r in rows], kind) for name, kind in _KINDS.items()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], names=["doc_id", *_KINDS])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, {SCHEMA}")
