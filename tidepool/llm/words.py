"""Words of a whole Arrow batch of texts, hashed with numpy.

A word is a maximal run of bytes outside ``{0x20, 0x09-0x0D}``. Nothing is
done per word in Python: a batch of texts is one byte buffer, word borders
are a mask over it, and each word is hashed eight bytes at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_M1 = np.uint64(0x7FB5D329728EA185)
_M2 = np.uint64(0x81DADEF4BC2DD44D)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (array of uint64 in, new array out)."""
    h = h ^ (h >> np.uint64(31))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n, wide = len(column), pa.types.is_large_string(column.type)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32,
                            n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Word positions of a batch: ``start``, ``end`` (byte offsets) and
    ``first`` (index of each text's first word; one more entry at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        space = SPACE[data]
        cut = np.zeros(n + 1, bool)  # a text border ends a word as well
        cut[offsets] = True
        cut[0] = cut[n] = True
        before, after = cut[:n].copy(), cut[1:].copy()
        before[1:] |= space[:-1]
        after[:-1] |= space[1:]
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word's bytes (A-Z lower-cased on request)."""
        return hash_spans(LOWER[self.data] if lower else self.data, self.start, self.end)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) + _STEP)
    which, at, left = np.arange(len(start)), start, size
    while len(which):
        part = eight[at]
        short = np.flatnonzero(left < 8)
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[which] = mix((h[which] ^ part) * _STEP)
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return h


def windows(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every ``n`` consecutive words: (hash per word position,
    True where the window lies inside one text)."""
    m = len(h)
    out = np.zeros(m, np.uint64)
    ok = np.zeros(m, bool)
    if m >= n:
        acc = np.zeros(m - n + 1, np.uint64)
        for i in range(n):
            acc *= _STEP
            acc += h[i:m - n + 1 + i]
        out[:m - n + 1] = mix(acc)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        ok[:m - n + 1] = owner[:m - n + 1] == owner[n - 1:]
    return out, ok


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text's range."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
