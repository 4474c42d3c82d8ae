"""Texts of Arrow batches as numpy arrays: UTF-8 bytes, words, rolling hashes.

Nothing here makes a Python object per word. A text is never split over two slices, so a task needs about forty bytes
for each byte of its longest text, or of ``SLICE_BYTES`` where that is more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once.
SLICE_BYTES = 1 << 20

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 20)) * _ODD) | U64(1)


_BYTE = constants(256, 1)
_PLACE = constants(4096, 2)
_STEP = constants(8, 3)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth table over bytes, true inside the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\x20\x09-\x0D]``, over UTF-8 bytes.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``, over UTF-8 bytes.
LETTERS_DIGITS = ~byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return _LOWER[data]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    if values is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each have about ``limit`` bytes; a longer text is alone."""
    for batch in batches:
        sizes = np.nan_to_num(
            pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float)
        )
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def hash_pieces(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the pieces, none empty, that follow each other in ``data``."""
    if not len(sizes):
        return np.empty(0, U64)
    places = np.cumsum(sizes)
    heads = places - sizes
    form = np.int32 if places[-1] < 1 << 31 else np.int64
    at = np.arange(places[-1], dtype=form) - np.repeat(heads.astype(form), sizes)
    weight = _PLACE[at & 4095]
    if sizes.max() > 4096:
        weight += (at >> 12).astype(U64) * _STEP[0]
    weight *= _BYTE[data]
    sums = np.add.reduceat(weight, heads)
    return mix(sums + sizes.astype(U64) * _STEP[1])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that start at ``starts``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


class Words:
    """The words of a slice: ``starts`` and ``ends`` in bytes; ``first[d]`` is the first word of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        inside = table[data]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[edges - 1] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return hash_pieces(self.data[self.inside], self.ends - self.starts)

    def windows(self, size: int) -> np.ndarray:
        """Words at which ``size`` words of one document start."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= size)


def rolling(words: np.ndarray, size: int, step: int = 2) -> np.ndarray:
    """At i a hash of words[i : i + size]; the last size - 1 places hold none."""
    out, done, at, base = None, 0, 1, mix(words.copy()) if step != 2 else words
    block, factor = base, _STEP[step]
    with np.errstate(over="ignore"):
        while True:
            if size & at:
                if out is None:
                    out = block.copy()
                else:  # what is gathered stands before this block
                    ahead = np.zeros_like(block)
                    ahead[: len(block) - done] = block[done:] if done else block
                    out = out * factor + ahead
                done += at
            if done == size:
                return mix(out)
            ahead = np.zeros_like(block)
            ahead[: max(0, len(block) - at)] = block[at:]
            block = block * factor + ahead
            factor = factor * factor
            at *= 2
