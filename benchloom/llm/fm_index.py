"""Full-text index over sequences of whole numbers: suffix order, wavelet ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every this many positions of a run, and its first, keep their place.
SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; each 0 is an end of its own, smaller the earlier it stands."""
    n = len(text)
    ends = text == 0
    m = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + m)
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.int64)
    reach = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - reach] = rank[reach:] + 1
        both = rank * (n + 1) + ahead
        order = np.argsort(both, kind="stable")
        ranked = both[order]
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        reach *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit level after the other."""

    def __init__(self, sequence: np.ndarray, top: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(sequence) - int(self.ones[-1][-1]))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))

    def rank(self, symbols: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For each list of places, how often the symbol stands before the place."""
        moved = [np.zeros_like(places[0]), *places]
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            moved = [np.where(one, zeros + ones[x], x - ones[x]) for x in moved]
        return [x - moved[0] for x in moved[1:]]


class FMIndex:
    """Index of a text of positive symbols up to ``top``, cut into runs that each end with 0."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        self.n = len(text)
        order = suffix_order(text)
        self.last = text[order - 1].astype(np.int64)  # the symbol before each suffix; before the first: an end
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.wavelet = WaveletMatrix(self.last, top)
        at = np.arange(self.n)
        begins = np.concatenate(([True], text[:-1] == 0))
        inside = at - np.maximum.accumulate(np.where(begins, at, 0))
        self.kept = np.where(inside[order] % SAMPLE == 0, order, -1)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 row of each pattern, a row of the matrix of symbols."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for symbols in patterns.T[::-1]:
            before, until = self.wavelet.rank(symbols, low, high)
            low, high = self.below[symbols] + before, self.below[symbols] + until
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row: steps back until a position that was kept."""
        found, steps, todo, rows = np.full(len(rows), -1, np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(todo):
            kept = self.kept[rows]
            done = kept >= 0
            found[todo[done]] = kept[done] + steps
            todo, rows = todo[~done], rows[~done]
            symbols = self.last[rows]
            rows = self.below[symbols] + self.wavelet.rank(symbols, rows)[0]
            steps += 1
        return found
