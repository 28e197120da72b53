"""Words, lines and their 64-bit hashes for a block of texts at once, in numpy.

A block is one byte array with the limits of its texts.  A hash of bytes s..e
is a difference of prefix sums of byte * base**position, brought back to
position 0 and mixed, so hashing all words costs a few passes over the block.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(name)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 1 << 23:
            _POWERS[name] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Hashes:
    """Hashes of any byte ranges of a block."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        powers = _powers("base", BASE, len(data) + 1)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=self.sums[1:])
        self.back = _powers("inverse", INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """Of the ranges [i, i + size) of all i."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = self.sums[size:] - self.sums[:n]
        h *= self.back[:n]
        return mix(h)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of marked bytes in a text, and the number of runs before each text (and in all)."""
    first = np.zeros(len(inside) + 1, bool)
    first[bounds] = True
    left = np.ones(len(inside), bool)
    left[1:] = ~inside[:-1]
    right = np.ones(len(inside), bool)
    right[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (left | first[:-1]))
    end = np.flatnonzero(inside & (right | first[1:])) + 1
    return start, end, np.searchsorted(start, bounds)


def word_ranges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+``, and the number of words before each text (and in all)."""
    return runs(~_SPACE[data], bounds)


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of the values of each text; exact, as values are integers or booleans."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys
