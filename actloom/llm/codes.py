"""Columnar text primitives: code points, runs and rolling polynomial hashes over whole Arrow batches.

All hashes are polynomials modulo 2**64 over mixed symbols.  With prefix sums ``P[i] = sum(v[j] * B**j, j < i)`` the
hash of any stretch ``s..e`` is ``(P[e] - P[s]) * B**-s``, so every run, shingle or field costs one subtraction.
Structured sequences of some thousand symbols can defeat a polynomial modulo a power of two, so words of ``LONG`` symbols
and more take a digest instead, and whole texts are always known by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
TOP = 0x110000
#: characters of a slice that is worked on at once; a longer single text forms a slice of its own
SLICE_CHARS = 1 << 20
#: symbols from which on a word is hashed by a digest
LONG = 1024


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class _Powers:
    def __init__(self, base: np.uint64) -> None:
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            with np.errstate(over="ignore"):
                step = np.uint64(self.values[-1] * self.base)
                self.values = np.concatenate([self.values, self.values * step])
        return self.values


_POW, _INV = _Powers(BASE), _Powers(INVERSE)


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    """Skip-and-fold table: 0 for a code point that is no letter or digit, else the code point of its lower-case form plus 1."""
    t = np.zeros(TOP, np.uint32)
    for i in range(TOP):
        c = chr(i)
        if c.isalnum():
            t[i] = ord(c.lower()[0]) + 1
    t[0x3C2] = t[0x3C3]  # final sigma
    return t


@lru_cache(maxsize=1)
def space_table() -> np.ndarray:
    t = np.zeros(TOP, bool)
    t[[i for i in range(0x3001) if chr(i).isspace()]] = True
    return t


def slices(arr: pa.Array | pa.ChunkedArray, limit: int = SLICE_CHARS) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) such that a slice holds about ``limit`` bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not len(arr):
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(arr):
        base = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield at, arr.slice(at, end - at)
        at = end


def points(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string array and the offsets of its rows; a null has none."""
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    n = len(arr)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    if not len(data) or data.max() < 128:
        return data, off
    try:
        cps = np.frombuffer(data.tobytes().decode().encode("utf-32-le", "surrogatepass"), np.uint32)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return cps, before[off]
    except UnicodeDecodeError:
        rows = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)]
        return np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal stretches of True within each row."""
    if not len(mask):
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(len(mask) + 1, bool)
    edge[off] = True
    first = mask & np.concatenate([[True], ~mask[:-1] | edge[1:-1]])
    last = mask & np.concatenate([~mask[1:] | edge[1:-1], [True]])
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(off, s, side="right") - 1


def prefix(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _POW.upto(len(values))[: len(values)], dtype=np.uint64)])


def stretch(pre: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the stretches s..e from the prefix sums."""
    with np.errstate(over="ignore"):
        return mix((pre[e] - pre[s]) * _INV.upto(len(pre))[s] + (e - s).astype(np.uint64))


def digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def digests(arr: pa.Array) -> pa.Array:
    """128-bit digests of the strings of an array; null stays null."""
    return pa.array([None if v is None else digest(v) for v in arr.cast(pa.binary()).to_pylist()], pa.binary())


def _long(h: np.ndarray, symbols: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    for i in np.flatnonzero(e - s >= LONG):
        h[i] = int.from_bytes(digest(symbols[s[i] : e[i]].astype("<u4").tobytes())[:8], "little")
    return h


def words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all words (maximal runs of letters and digits, lower-cased), in order."""
    cps, off = points(arr)
    folded = word_table()[cps]
    s, e, row = runs(folded > 0, off)
    return _long(stretch(prefix(mix(folded)), s, e), folded, s, e), row


def spaced(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, rows, starts and ends of what stands between whitespace, character for character."""
    cps, off = points(arr)
    s, e, row = runs(~space_table()[cps], off)
    return _long(stretch(prefix(mix(cps)), s, e), cps, s, e), row, s - off[row], e - off[row]


def bounds(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets of n rows in a sorted row column."""
    return np.searchsorted(row, np.arange(n + 1))


PAIR = np.dtype([("x", "<u8"), ("y", "<u8")])


def pairs_of(column: pa.Array) -> np.ndarray:
    """A binary(16) column as 128-bit numbers (two fields of 64 bits)."""
    return np.frombuffer(b"".join(column.to_pylist()), PAIR)


def binaries(keys: np.ndarray) -> pa.Array:
    """128-bit numbers as a binary column."""
    flat = np.ascontiguousarray(keys)
    return pa.Array.from_buffers(pa.binary(16), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def distinct_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the first of each distinct number, number of each row among them)."""
    order = np.lexsort((keys["y"], keys["x"]))
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    which = np.empty(len(k), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
