"""Vectorised text primitives shared by the training-data operators.

Everything here works on whole Arrow string columns as flat byte buffers, so
the per-word cost is a few numpy passes and no Python object is made per word.
Words are runs of anything but the six ASCII white-space bytes
(0x20, 0x09-0x0D), which is the same set in UTF-8 and in code points.

Hashes are polynomial (Rabin-Karp) over 64-bit words with an odd base, undone
for position by the inverse power, and then finalised by an avalanche mix.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass holds; temporaries are about 60 times this.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLES: dict[str, np.ndarray] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def return_memory() -> None:
    """Have freed arrays go back to the system at once.

    A worker lives on between tasks, and several share an executor's memory:
    arrays of a megabyte or more are mapped one by one, and Arrow uses the same
    allocator, so that what one task freed is not kept from the others."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which otherwise adapts upwards
    except (OSError, AttributeError):
        return  # another C library
    pa.set_memory_pool(pa.system_memory_pool())


return_memory()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _TABLES.get("pow")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("pow", _BASE), ("inv", _INV)):
            table = np.empty(size, np.uint64)
            table[0] = 1
            filled = 1
            while filled < size:
                step = min(filled, size - filled)
                table[filled : filled + step] = table[:step] * np.uint64(pow(int(base), filled, 1 << 64))
                filled += step
            _TABLES[name] = table
    return _TABLES["pow"], _TABLES["inv"]


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (n + 1) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each (a longer row stands alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


class Words:
    """Words of a slice of rows.

    start, end: byte positions in `data`; first: index of each row's first
    word, n + 1 long; hash: one mixed 64-bit hash a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        gap = np.ones(n + 1, bool)
        gap[:n] = _SPACE[data]
        inside = ~gap[:n]
        left = np.ones(n, bool)
        left[1:] = gap[: n - 1]
        breaks = offsets[1:-1]
        breaks = breaks[breaks < n]
        left[breaks] = True
        self.start = np.flatnonzero(inside & left)
        right = gap[1:].copy()
        right[breaks[breaks > 0] - 1] = True
        self.end = np.flatnonzero(inside & right) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hash() if hashed else None

    def _hash(self) -> np.ndarray:
        n = len(self.data)
        power, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        out = (sums[self.end] - sums[self.start]) * inverse[self.start]
        return mix64(out + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and the hash, of each run of k words in one row."""
        starts = window_starts(self.first, k)
        return starts, window_hash(self.hash, starts, k)


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Word indices at which k words of the same row begin."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int32)
    have = np.diff(first) >= k
    np.add.at(ok, first[:-1][have], 1)
    np.add.at(ok, first[1:][have] - k + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def window_hash(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hash of each k-word window, from prefix sums."""
    n = len(words)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=sums[1:])
    return mix64((sums[starts + k] - sums[starts]) * inverse[starts])


def gather(flat_values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of flat_values[begin[i] : begin[i] + length[i]]."""
    total = int(length.sum())
    if not total:
        return flat_values[:0]
    shift = np.repeat(begin - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    return flat_values[shift + np.arange(total)]


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.large_binary()) -> pa.Array:
    """An Arrow array over these bytes, without a copy."""
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
