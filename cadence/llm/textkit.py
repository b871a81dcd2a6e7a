"""Vectorized text helpers used inside Spark tasks: words, lines and their 64-bit hashes over Arrow string buffers.

Texts stay in the UTF-8 buffer that Arrow hands to the task; every step is a numpy pass over that buffer, block by
block, so a batch of any size needs memory for one block (or for one text, if that text is longer than a block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U64 = np.uint64
MASK64 = (1 << 64) - 1


def splitmix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads close inputs (public splitmix64 finalizer)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def random_u64(n: int, seed: int) -> np.ndarray:
    """``n`` reproducible 64-bit numbers; the same on every executor."""
    return splitmix(splitmix(np.arange(1, n + 1, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15) + _U64(seed)))


_BYTE = random_u64(256, 11)
_LOWER_MAP = np.arange(256, dtype=np.uint8)
_LOWER_MAP[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER_MAP]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the largest n seen so far."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base & MASK64, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and the n + 1 offsets of the texts in them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type):
        kind = np.int32
    elif pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        return utf8(column.cast(pa.string()))
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    if not len(off):
        return raw[:0], np.zeros(1, dtype=np.int64)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``size`` bytes each; one longer text makes a range of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-text bounds of the maximal runs of true bytes; runs never cross two texts."""
    if not len(flag):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    edge = np.zeros(len(flag) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(flag), dtype=bool)
    before[0] = False
    before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | edge[:-1]))
    after = np.empty(len(flag), dtype=bool)
    after[-1] = False
    after[:-1] = flag[1:]
    ends = np.flatnonzero(flag & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes (A-Z read as a-z if ``lower``).

    A polynomial in an odd base over random byte values, by prefix sums; spans are taken in groups of about
    BLOCK_BYTES so that powers and sums stay small however long the text is."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
        n = int(ends[lo:hi].max()) - base
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(table[raw[base : base + n]] * _power(_BASE, n), out=total[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (total[e] - total[s]) * _power(_INVERSE, n + 1)[s] + (e - s).astype(np.uint64)
        lo = hi
    return splitmix(out)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words ``[^\\x20\\x09-\\x0D]+`` and the bounds of each text's words among them."""
    return runs(~SPACE[raw], offsets)


_MULT = random_u64(64, 23) | _U64(1)


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` consecutive items inside each text, and each text's bounds among them."""
    n = len(hashes) - k + 1
    per = np.maximum(np.diff(bounds) - (k - 1), 0)
    out_bounds = np.concatenate([[0], np.cumsum(per)])
    if n <= 0 or not out_bounds[-1]:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    total = hashes[:n] * _MULT[0]
    for j in range(1, k):
        total += hashes[j : j + n] * _MULT[j % 64] + _U64(j)
    inside = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(inside, bounds[:-1][per > 0], 1)
    np.add.at(inside, (bounds[:-1] + per)[per > 0], -1)
    return splitmix(total[np.cumsum(inside[:-1])[:n] > 0]), out_bounds


def combine(*columns: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several equally long 64-bit columns."""
    total = np.zeros(len(columns[0]), dtype=np.uint64)
    for j, c in enumerate(columns):
        total = splitmix(total * _MULT[1] + c * _MULT[2] + _U64(j + 1))
    return total


def signed(x: np.ndarray) -> pa.Array:
    """An unsigned 64-bit column as Spark's long."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def binaries(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(matrix.tobytes())])


def longs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrays of longs: row i holds values[bounds[i]:bounds[i+1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.ascontiguousarray(values).view(np.int64)))
