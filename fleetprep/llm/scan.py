"""Whole texts as numpy arrays: words, hashes of words, and hashes of word windows, a few megabytes of text at a time.

All functions take every byte of every text. A null text is an empty text. Hashes have 64 bits; they are functions of the
bytes alone and so agree between tasks, retries and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SLICE_BYTES = 3 << 20
INLINE = 64  # longer words and spans are hashed one by one

_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _P2
    x = (x ^ (x >> np.uint64(27))) * _P3
    return x ^ (x >> np.uint64(31))


#: one odd factor for each place in a window; factors in proportion to the place would give "x y y x" and "y x x y" one hash
_SALT = mix(np.arange(1, 65, dtype=np.uint64) * _P1) | np.uint64(1)


@dataclass
class Texts:
    """Some whole documents as one byte array; each is followed by one line feed."""

    buf: np.ndarray  # uint8, eight spare bytes at the end
    off: np.ndarray  # byte offset of each document, and the end
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    first: np.ndarray  # index of each document's first word, and the number of words

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.sizes)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """Runs of rows with at most `limit` bytes of text (or one row)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0, int)
    lo = 0
    while lo < len(column):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield lo, hi, column.slice(lo, hi - lo)
        lo = hi


def read(column: pa.Array, lower: bool = False, spaces: np.ndarray = SPACES) -> Texts:
    """The words of a slice: longest runs of bytes that are not in `spaces`; lower: A-Z become a-z first."""
    column = pc.ascii_lower(column) if lower else column
    column = pc.binary_join_element_wise(column, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.zeros(int(off[-1] - off[0]) + 8, np.uint8)
    if data is not None:
        buf[:-8] = np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    gap = spaces[buf[: len(buf) - 7]]
    gap[-1] = True
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(gap) and not gap[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    return Texts(buf, off, start, end, np.searchsorted(start, off))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes."""
    size = end - start
    h = mix(size.astype(np.uint64) * _P1 + np.uint64(1))
    eight = np.ndarray((max(len(buf) - 7, 0),), "<u8", buf.tobytes() if not buf.flags.c_contiguous else buf, strides=(1,))
    which, at = None, 0
    while at < INLINE:
        i = slice(None) if which is None else which
        v = eight[start[i] + at] & _KEEP[np.minimum(size[i] - at, 8)]
        h[i] = mix((h[i] ^ v) * _P1)
        at += 8
        which = np.flatnonzero(size > at) if which is None else which[size[which] > at]
        if not len(which):
            return h
    for i in which:
        h[i] = xxhash.xxh3_64_intdigest(buf[start[i] : end[i]].tobytes())
    return h


def windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` words in a row within a document, and the index of their first words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += h[k : k + n] * _SALT[k]
    last = np.repeat(first[1:], np.diff(first))[:n]  # where the document of each word ends
    at = np.flatnonzero(np.arange(width, width + n) <= last)
    return mix(out[at] ^ np.uint64(width)), at


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of values over [off[i], off[i+1]); empty ranges give 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]
