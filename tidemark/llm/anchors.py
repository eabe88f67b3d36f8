"""Content-defined anchors of texts: places that equal passages share, wherever they stand.

Of the spans of ``GRAM`` bytes in a window of ``PASSAGE`` bytes the one with the smallest hash,
the leftmost if several tie, is the window's anchor. It depends on the window's bytes alone,
so equal windows have their anchor at the same place within. Every window belongs to one
anchor; the windows of an anchor start next to each other and make up its context.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import _BASE, _BYTE, mix, powers

PASSAGE = 200
GRAM = 50
# Places a gram may start at within a window.
PLACES = PASSAGE - GRAM + 1
# Window starts that are worked on at once: places are packed into the low 24 bits of a hash.
STRETCH = (1 << 24) - PASSAGE
_LOW = np.uint64(0xFFFFFF)


class Hashed:
    """Running hash of a buffer; spans of any length hash alike wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.running = np.zeros(len(data) + 1, np.uint64)
        forward, self.inverse = powers(len(data) + 1)
        np.cumsum(_BYTE[data] * forward[: len(data)], out=self.running[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = (ends - starts).astype(np.uint64)
        return mix((self.running[ends] - self.running[starts]) * self.inverse[starts] + size * _BASE)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from minima that run to and from block edges."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:n], from_left[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[Hashed, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hashed buffer and, per anchor: its place, start and end of its context, its text's number.

    Texts shorter than a passage have none.
    """
    hashed = Hashed(data)
    rows: list[tuple] = [(np.zeros(0, np.int64),) * 4]
    for k in range(len(offsets) - 1):
        low, high = int(offsets[k]), int(offsets[k + 1])
        for a in range(low, high - PASSAGE + 1, STRETCH):
            b = min(high, a + STRETCH + PASSAGE - 1)
            starts = np.arange(a, b - GRAM + 1)
            packed = (hashed.spans(starts, starts + GRAM) & ~_LOW) | (starts - a).astype(np.uint64)
            at = (_least(packed, PLACES) & _LOW).astype(np.int64) + a
            first = np.flatnonzero(np.insert(at[1:] != at[:-1], 0, True))
            last = np.append(first[1:], len(at)) - 1
            rows.append((at[first], a + first, a + last + PASSAGE, np.full(len(first), k)))
    at, start, end, owner = (np.concatenate(column) for column in zip(*rows))
    return hashed, at, start, end, owner
