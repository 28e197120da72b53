"""Suffix order, longest previous and next factors of a collection of strings, in numpy.

All lengths are cut off at a given depth, and no match crosses the end of its
string.  The factor arrays come from the neighbours in suffix order with the
nearest smaller (or larger) position on either side.
"""

from __future__ import annotations

import numpy as np


class Suffixes:
    """The strings, one after the other, each closed by a symbol of its own."""

    def __init__(self, strings: list[bytes], depth: int):
        self.depth = depth
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        symbols = np.zeros(int(self.starts[-1]), np.int64)
        within = np.ones(len(symbols), bool)
        closes = self.starts[1:] - 1
        within[closes] = False
        symbols[within] = np.frombuffer(b"".join(strings), np.uint8)
        symbols[closes] = 256 + np.arange(len(strings))
        self.ranks: list[tuple[int, np.ndarray]] = []  # (length, rank of each position by so many symbols)
        rank, length = symbols, 1
        order = np.arange(len(symbols))
        while len(symbols):
            self.ranks.append((length, rank.astype(np.int32)))
            if length >= depth:
                break
            rank, order, distinct = self._double(rank, length)
            length *= 2
            if distinct and length < depth:
                self.ranks.append((length, rank.astype(np.int32)))
                break
        self.order = order if len(self.ranks) > 1 else np.argsort(rank)

    @staticmethod
    def _double(rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, bool]:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:] + 1
        key = rank << np.int64(31) | after
        order = np.argsort(key)
        ordered = key[order]
        step = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        new = np.empty_like(rank)
        new[order] = step
        return new, order, bool(step[-1] == len(rank) - 1)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The lengths (up to the depth, rounded up to a power of two) of the common prefixes at two positions."""
        size = np.zeros(len(a), np.int64)
        n = len(self.order)
        for length, rank in reversed(self.ranks):
            i, j = a + size, b + size
            inside = (i < n) & (j < n)
            i[~inside] = j[~inside] = 0
            size += np.where(inside & (rank[i] == rank[j]) & (a != b), length, 0)
        return size

    def factors(self, earlier: bool = True, among: np.ndarray | None = None) -> np.ndarray:
        """For each position the longest match that starts at an earlier (or later) one.

        ``among`` marks the positions that take part; the others match nothing.
        """
        order = self.order if among is None else self.order[among[self.order]]
        at = order if earlier else -order
        longest = np.zeros(len(self.order), np.int64)
        for side in (1, -1):
            near = nearest_smaller(at[::side])
            has = np.flatnonzero(near >= 0)
            own, other = order[::side][has], order[::side][near[has]]
            longest[own] = np.maximum(longest[own], self.common(own, other))
        return longest


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1.

    Blocks' minima in a tree: each place climbs while the block on its left has
    no smaller value, then descends into the one that has; all places at once.
    """
    n = len(values)
    levels = [np.asarray(values, np.int64)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        if len(low) % 2:
            low = levels[-1] = np.concatenate([low, [np.iinfo(np.int64).max]])
        levels.append(np.minimum(low[0::2], low[1::2]))
    node = np.arange(n)
    found = np.full(n, -1)
    active = np.arange(n)
    state = np.full(n, -1)  # level at which a block with a smaller value was met
    place = np.zeros(n, np.int64)
    for level in range(len(levels)):
        if not len(active):
            break
        here = node[active]
        left = here - 1
        right_child = here % 2 == 1
        hit = right_child & (levels[level][np.maximum(left, 0)] < values[active])
        state[active[hit]], place[active[hit]] = level, left[hit]
        active = active[~hit]
        node[active] >>= 1
    for level in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(state == level)
        if not len(down):
            continue
        right = place[down] * 2 + 1
        smaller = levels[level - 1][right] < values[down]
        place[down] = np.where(smaller, right, right - 1)
        state[down] = level - 1
    met = state == 0
    found[met] = place[met]
    return found
