"""Deep-shallow sorting of byte strings, and the windows that sorted contexts share.

Strings are first sorted by multikey quicksort, eight bytes a step, to a shallow depth. What
then still ties shares a long prefix; such groups are ordered by a blind trie, which keeps
only the places where strings part, so that each string is compared once.
"""

from __future__ import annotations

import numpy as np

STEP = 8
SHALLOW = 64


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Compacted trie that knows where strings part but not what lies between."""

    class Node:
        __slots__ = ("depth", "children", "leaf")

        def __init__(self, depth: int, leaf: int):
            # ``leaf`` is some string below the node; strings that end at ``depth`` go under -1
            self.depth, self.leaf, self.children = depth, leaf, None

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: BlindTrie.Node | None = None
        self.same: dict[int, list[int]] = {}

    @staticmethod
    def _branch(string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    def insert(self, k: int) -> None:
        string = self.strings[k]
        if self.root is None:
            self.root = self.Node(len(string), k)
            return
        path, node = [], self.root
        # descend by branching bytes alone; any leaf below shares as much as can be shared
        while node.children is not None:
            path.append(node)
            node = node.children.get(self._branch(string, node.depth)) or next(iter(node.children.values()))
        path.append(node)
        other = self.strings[node.leaf]
        shared = common(string, other)
        if shared == len(string) == len(other):
            self.same.setdefault(node.leaf, []).append(k)
            return
        leaf = self.Node(len(string), k)
        parent = None
        for node in path:
            if node.children is None or node.depth >= shared:
                break
            parent = node
        if node.children is not None and node.depth == shared:
            node.children[self._branch(string, shared)] = leaf
            return
        split = self.Node(shared, node.leaf)
        split.children = {self._branch(self.strings[node.leaf], shared): node, self._branch(string, shared): leaf}
        if parent is None:
            self.root = split
        else:
            parent.children[self._branch(string, parent.depth)] = split

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node.children is None:
                out.append(node.leaf)
                out += self.same.get(node.leaf, ())
            else:
                stack += [node.children[b] for b in sorted(node.children, reverse=True)]
        return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indices of the strings in order."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) <= 1:
            out += group
            continue
        if depth >= shallow:
            trie = BlindTrie(strings)
            for k in group:
                trie.insert(k)
            out += trie.ordered()
            continue
        # a string that ends within the step sorts before its continuations: shorter keys are smaller
        keys = [strings[k][depth : depth + STEP] for k in group]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less, equal, more = [], [], []
        for k, key in zip(group, keys):
            (less if key < pivot else equal if key == pivot else more).append(k)
        stack.append((more, depth))
        if len(pivot) < STEP:
            stack.append((equal, max(depth, shallow) if len(equal) > 1 else depth))
        else:
            stack.append((equal, depth + STEP))
        stack.append((less, depth))
    return out


def ranked(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within each group, and the common prefix of each with its predecessor.

    ``groups`` numbers the groups, equal numbers side by side; a group's first string has -1.
    """
    order: list[int] = []
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(strings)]
    shared = np.full(len(strings), -1, np.int64)
    for a, b in zip(cuts, cuts[1:]):
        own = [a + k for k in deep_shallow(strings[a:b])]
        for k in range(1, len(own)):
            shared[a + k] = common(strings[own[k - 1]], strings[own[k]])
        order += own
    return np.array(order, np.int64), shared


def shared_windows(
    contexts: list[bytes], places: np.ndarray, counts: np.ndarray, groups: np.ndarray, passage: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per context: first and last start of a window of ``passage`` bytes that occurs twice, else -1.

    The contexts of one group hold the same gram, the k-th at ``places[k]``. Windows are told
    apart by where the gram stands within: two are equal if what is left of it and what is
    right of it are, which two sorted orders tell, one of the right parts and one of the
    mirrored left parts. A context that occurs ``counts[k]`` > 1 times repeats all its windows.
    """
    n = len(contexts)
    right = np.array([len(c) for c in contexts], np.int64) - places
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    right_order, right_shared = ranked([c[p:] for c, p in zip(contexts, places.tolist())], groups)
    left_order, left_shared = ranked([c[:p][::-1] for c, p in zip(contexts, places.tolist())], groups)
    right_class, left_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for before in range(int(places.max(initial=-1)), -1, -1):
        fits = np.flatnonzero((places >= before) & (right >= passage - before))
        if not len(fits):
            continue
        right_class[right_order] = np.cumsum(right_shared < passage - before)
        left_class[left_order] = np.cumsum(left_shared < before)
        pair = right_class[fits] * (n + 2) + left_class[fits]
        _, back, size = np.unique(pair, return_inverse=True, return_counts=True)
        again = fits[(size[back] > 1) | (counts[fits] > 1)]
        start = places[again] - before
        first[again] = np.where(first[again] < 0, start, np.minimum(first[again], start))
        last[again] = np.maximum(last[again], start)
    return first, last
