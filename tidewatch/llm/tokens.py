"""Words of many texts at a time, as numpy arrays over an Arrow text column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time and, as a rule, bytes of texts handled together.
PIECE = 1 << 20
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(0xFFFF, 0x9E3779B97F4A7C15 | 1, np.uint64)], dtype=np.uint64)


def byte_table(separators: bytes) -> np.ndarray:
    """Byte to byte: 0 for a separator, A-Z lowered, the others as they are. 0 is always a separator."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Every ASCII character but digits and letters separates words.
ALPHANUMERIC = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


@dataclass
class Words:
    """Words of the texts ``first`` to ``first + count - 1`` of a column, in order.

    ``text`` holds the mapped bytes, ``start`` and ``length`` place each word in it, ``doc`` is its text
    (from 0), ``hash`` a 64-bit hash."""

    first: int
    count: int
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def word(self, i: int) -> bytes:
        return self.text[self.start[i] : self.start[i] + self.length[i]].tobytes()


def _pieces(text: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that cut no word: they end at a separator or where a text ends."""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + size)
        while hi < len(text):
            gap = np.flatnonzero(text[hi : hi + size] == 0)
            edge = bounds[np.searchsorted(bounds, hi)]
            hi = min(edge, hi + gap[0]) if len(gap) else min(edge, hi + size)
            if len(gap) or hi == edge:
                break
        yield lo, hi
        lo = hi


def words_of(column: pa.Array, table: np.ndarray, size: int = PIECE) -> Iterator[Words]:
    """The words of a text column, some texts of about ``size`` bytes at a time; a null has none. A text is never cut in two."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        bounds = offsets[first : last + 1] - offsets[first]
        text = table[data[offsets[first] : offsets[last]]]
        starts, lengths, hashes = [], [], []
        for lo, hi in _pieces(text, bounds, size):
            t = text[lo:hi]
            inside = t != 0
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            edges = bounds[(bounds >= lo) & (bounds < hi)] - lo
            begins[edges] = inside[edges]
            s = np.flatnonzero(begins)
            if len(s):
                s0 = s[0]
                at = np.arange(s0, len(t)) - s[np.cumsum(begins[s0:]) - 1]
                h = np.add.reduceat(t[s0:].astype(np.uint64) * _POWERS[at & 0xFFFF], s - s0)
                starts.append(s + lo)
                lengths.append(np.add.reduceat(inside[s0:].astype(np.int64), s - s0))
                hashes.append(h)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        start = join(starts, np.int64)
        yield Words(
            first, last - first, text, start, join(lengths, np.int64),
            np.searchsorted(bounds, start, "right") - 1, join(hashes, np.uint64),
        )
        first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """A hash whose order says nothing about its input."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on, the last k - 1 left out."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for j in range(1, k):
        g = g * np.uint64(0x100000001B3) + h[j : j + n]
    return mixed(g)
