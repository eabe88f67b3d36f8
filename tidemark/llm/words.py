"""Vectorised words, lines and hashes of a batch of texts.

The texts of an Arrow batch lie back to back in one byte buffer. Everything here works on
that buffer with numpy, so that a task costs a few array passes instead of a Python loop
per word. Hashes are 64-bit polynomials over random byte values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at once; a longer single text makes a slice of its own.
# Array passes take more than twenty times as much memory, much of which a reused worker keeps.
SLICE_BYTES = 512 << 10

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(int(_random.integers(1, 2**62)) * 4 + 3)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# Byte classes, fixed by the contracts: white space, lower-cased word bytes, A-Z to a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
ALNUM = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    ALNUM[_low : _high + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = batch.column(column).fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, back to back, and the ``len + 1`` offsets of the texts; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of bytes of class ``is_word``; none crosses a text."""
    mask = is_word[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse for i < n, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _UNBASE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def prefixes(data: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes; ``between`` gets hashes of any span from it."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def between(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start up to its end."""
    inverse = powers(len(running))[1]
    return mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive words of one text, and the index of their first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        total += hashes[at + k] * _STEP[k]
    return mix(total), at


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of byte-wise ``values`` over each text."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]
