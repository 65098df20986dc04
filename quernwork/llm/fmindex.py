"""FM-index over a wavelet matrix, searched backward for many patterns at once.

Suffixes are sorted by their first ``CONTEXT`` symbols only (a bounded-context transform). Backward search is exact on
it for patterns up to that length: the suffixes that begin with a pattern of m symbols still stand together, and those
before them are all smaller in their first m symbols, which is all that a step needs.
"""

from __future__ import annotations

import numpy as np

CONTEXT = 128


def sort_suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the suffixes of ``codes`` in the order of their first ``CONTEXT`` symbols, and the rank of
    each position in that order, equal for suffixes that agree so far."""
    n = len(codes)
    if n == 0:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    rank = codes.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while width < CONTEXT:
        key = rank * (int(rank.max()) + 2)
        if width < n:
            key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        steps = np.zeros(n, np.int64)
        ordered = key[order]
        np.cumsum(ordered[1:] != ordered[:-1], out=steps[1:])
        rank[order] = steps
        width *= 2
    return order.astype(np.int32), rank.astype(np.int32)


class Bits:
    """A bit vector of packed words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        words = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bits.dtype)), bitorder="little")
        self.words = words.view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        """How many of the first ``upto`` bits are set."""
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Index of a sequence of codes 1..sigma; 0 stands between records and matches nothing.

    It keeps the wavelet matrix, ``rank`` by position and, in the order of the suffixes, which record each lies in
    (``owner``) and where the next one of another record is (``next_other``); the suffix array itself is dropped.
    """

    def __init__(self, codes: np.ndarray, sigma: int, owner: np.ndarray) -> None:
        suffixes, self.rank = sort_suffixes(codes)
        self.owner = owner[suffixes].astype(np.int32)
        n = len(codes)
        change = np.flatnonzero(self.owner[1:] != self.owner[:-1]) + 1
        ends = np.append(change, n)
        self.next_other = np.repeat(ends, np.diff(np.append(0, ends))).astype(np.int32)
        last = codes[suffixes - 1]  # of position 0 that is the final code, a 0
        self.first = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(codes, minlength=sigma + 1), out=self.first[1:])
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, int(sigma).bit_length()))):
            ones = (last >> bit) & 1
            zeros = int(len(last) - ones.sum())
            self.levels.append((bit, Bits(ones.astype(np.uint8)), zeros))
            last = np.concatenate([last[ones == 0], last[ones == 1]])
        every = np.arange(sigma + 1)
        self.base = self.first[every] - self._walk(every, np.zeros(sigma + 1, np.int64))

    def _walk(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((codes >> bit) & 1, zeros + ones, at - ones)
        return at

    def extend(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of each pattern with one more code before it."""
        both = self._walk(np.concatenate([codes, codes]), np.concatenate([low, high])) + np.tile(self.base[codes], 2)
        return both[: len(low)], both[len(low) :]

    def alone(self, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether an interval is empty or holds suffixes of the record ``owner`` only."""
        at = np.minimum(low, len(self.owner) - 1)
        return (low >= high) | ((self.owner[at] == owner) & (self.next_other[at] >= high))
