"""Whole texts as bytes in numpy: word spans and word hashes of many documents at once.

A word is a run of bytes other than white space (9 to 13 and 32); A to Z count as lower case in hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 1 << 19  # bytes worked on at a time
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256)
LOWER[65:91] += 32
VALUE = np.where(IS_WORD, LOWER + 1, 0).astype(np.uint64)
BASE = 0x9E3779B97F4A7C15 | 1
U64 = (1 << 64) - 1


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
        return self.up, self.down


POWERS = Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column and the n + 1 offsets of the strings in them; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes, at least one document each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin; a document's first byte begins a word if it is in one."""
    word = IS_WORD[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start[first] = word[first]
    return np.flatnonzero(start)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the n + 1 offsets of the documents among the words."""
    starts = word_starts(data, offsets)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + STEP)))
        begin, end = starts[i], starts[j] if j < len(starts) else len(data)
        up, down = POWERS.upto(int(end - begin))
        at = starts[i:j] - begin
        out[i:j] = np.add.reduceat(VALUE[data[begin:end]] * up[:end - begin], at) * down[at]
        i = j
    return mix(out), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of runs of ``size`` words, sorted; of all words, if they are fewer; none of none."""
    n = len(words)
    if not n:
        return words
    run = min(size, n)
    h = np.full(n - run + 1, run if n < size else 0, np.uint64)
    for k in range(run):
        h = mix(h * np.uint64(BASE) + words[k:k + n - run + 1])
    return np.unique(h)


def count_words(column: pa.Array) -> np.ndarray:
    """The number of words of each text of a column."""
    data, offsets = bytes_of(column)
    counts = np.zeros(len(column), np.int64)
    for lo, hi in slices(offsets):
        part = offsets[lo:hi + 1] - offsets[lo]
        counts[lo:hi] = np.diff(np.searchsorted(word_starts(data[offsets[lo]:offsets[hi]], part), part))
    return counts
