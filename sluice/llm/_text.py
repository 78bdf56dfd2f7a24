"""Vectorised text primitives over Arrow string arrays.

A batch of strings is handled as one byte array: words are found with a 256-entry
byte table and hashed with prefix sums of a random polynomial, so the cost per byte
is a few numpy passes and no Python loop runs over words.  Work is cut into slices of
about ``SLICE_BYTES`` of text, which bounds the memory of a task whatever the batch
size is; a single longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)


def lean() -> None:
    """Gives back what other operators keep in this worker process (encoders' chunks), and freed memory to the system."""
    if (tokens := sys.modules.get(f"{__package__}.tokens")) is not None:
        tokens._encoders.clear()
    trim()


def trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another libc
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, stream: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit integers, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(stream << 32)) * _ODD)


_BYTE = seeds(256, 7)
_P = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_pow = np.ones(1, dtype=U64)
_ipow = np.ones(1, dtype=U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _ipow
    if len(_pow) >= n:
        return _pow[:n], _ipow[:n]
    both = []
    for base in (_P, _P_INV):
        out = np.ones(max(n, SLICE_BYTES + (1 << 14)), dtype=U64)
        done, step = 1, base
        while done < len(out):  # doubling: out[done:2*done] = out[:done] * base**done
            m = min(done, len(out) - done)
            out[done : done + m] = out[:m] * U64(step)
            done, step = done + m, step * step % (1 << 64)
        both.append(out)
    if n <= SLICE_BYTES + (1 << 14):
        _pow, _ipow = both
    return both[0][:n], both[1][:n]


def table(words: str, fold: str = "") -> np.ndarray:
    """A byte-to-byte table: 0 for bytes outside words, else the byte as it counts.

    words: ``space`` (all but 0x20 and 0x09-0x0D) or ``alnum`` (letters, digits and all bytes
    from 0x80).  fold: ``lower`` maps A-Z to a-z; ``line`` also maps digits to 0.
    """
    t = np.arange(256, dtype=np.uint8)
    if fold:
        t[65:91] += 32
    if fold == "line":
        t[48:58] = 48
    keep = np.ones(256, dtype=bool)
    if words == "space":
        keep[[32, 9, 10, 11, 12, 13]] = False
    else:
        keep[:128] = False
        for a, b in ((48, 58), (65, 91), (97, 123)):
            keep[a:b] = True
        if not fold:
            keep[65:91] = True
    t[~keep] = 0
    if words == "space":
        keep[0] = True
    t[0] = 1 if words == "space" else 0  # NUL is a word byte there
    if words == "space":
        t[1] = 2
        t[2] = 3  # bytes 1..8 stay distinct from NUL
        t[3:9] = np.arange(4, 10, dtype=np.uint8)
    return t


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; nulls count as empty."""
    if pa.types.is_large_string(arr.type) or arr.null_count or arr.type != pa.string():
        arr = arr.cast(pa.large_string()).fill_null("")
        kind = np.int64
    else:
        kind = np.int32
    if len(arr) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def slices(arr: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of rows with about ``most`` bytes each."""
    off, raw = buffers(arr)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, off[i : j + 1] - off[i], raw[off[i] : off[j]]
        i = j


class Words:
    """The words of a slice: hash, byte range [start, end) and row of each, in text order."""

    def __init__(self, off: np.ndarray, raw: np.ndarray, how: np.ndarray, hashes: bool = True):
        n = len(raw)
        code = how[raw]
        inside = code != 0
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        first = off[:-1][off[:-1] < n]
        before[first] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        after[first[first > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(off, self.start, "right") - 1
        self.counts = np.bincount(self.row, minlength=len(off) - 1)
        self.bounds = np.concatenate(([0], np.cumsum(self.counts)))  # words of row r: bounds[r]:bounds[r+1]
        if hashes:
            self.prefix, self.ipow = prefix_sums(code)
            self.hash = range_hash(self.prefix, self.ipow, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)


def prefix_sums(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p, ip = _powers(len(code) + 1)
    out = np.zeros(len(code) + 1, dtype=U64)
    np.cumsum(_BYTE[code] * p[: len(code)], out=out[1:])
    return out, ip


def range_hash(prefix: np.ndarray, ipow: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes wherever they stand."""
    h = (prefix[end] - prefix[start]) * ipow[start]
    return mix(h + (end - start).astype(U64) * _ODD)


def grams(words: Words, n: int, whole_if_shorter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of every run of n words within a row.

    whole_if_shorter: a row with 1 to n-1 words gives its whole sequence as one gram.
    """
    h, m = words.hash, len(words)
    k = max(0, m - n + 1)
    out = np.zeros(k, dtype=U64)
    mult = seeds(n + 1, 11) | U64(1)
    for j in range(n):
        out += h[j : j + k] * mult[j]
    ok = words.row[:k] == words.row[n - 1 : n - 1 + k]
    at = np.flatnonzero(ok)
    row, out = words.row[at], mix(out[at])
    if whole_if_shorter:
        few = np.flatnonzero((words.counts > 0) & (words.counts < n))
        if len(few):
            extra = np.zeros(len(few), dtype=U64)
            size = words.counts[few]
            first = words.bounds[few]
            for j in range(n - 1):
                has = size > j
                extra[has] += h[first[has] + j] * mult[j]
            extra = mix(extra ^ mix(size.astype(U64) * _ODD))
            row, at, out = np.concatenate((row, few)), np.concatenate((at, first)), np.concatenate((out, extra))
            order = np.argsort(row, kind="stable")
            row, at, out = row[order], at[order], out[order]
    return row, at, out


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs, sorted by row and then value."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    if len(r):
        keep = np.ones(len(r), dtype=bool)
        keep[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
        r, v = r[keep], v[keep]
    return r, v


def list_of(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array with values[bounds[i]:bounds[i+1]] in row i."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def binary_of(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array with the bytes of values[bounds[i]:bounds[i+1]] in row i."""
    off = np.asarray(bounds, dtype=np.int32) * np.int32(values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])
