"""Arrow text columns as numpy arrays: bounded chunks, words, hashes, and byte blobs for exchanges.

All functions work on whole texts. A chunk holds whole rows; a single row larger than the limit is a chunk of
its own, so memory is bounded by the limit or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.default_rng(20240607)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word that white space ends: all but 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

_powers: dict[str, np.ndarray] = {}


def powers(n: int, which: str = "up") -> np.ndarray:
    """BASE**i (``up``) or its inverse (``down``) modulo 2**64, for i below n."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        p = np.full(size, BASE if which == "up" else BASE_INV, dtype=np.uint64)
        p[0] = 1
        have = _powers[which] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Chunk:
    """Rows ``first .. first + n`` of a batch; row i has bytes ``data[bounds[i]:bounds[i + 1]]``."""

    first: int
    n: int
    data: np.ndarray
    bounds: np.ndarray


def chunks(column: pa.Array, limit: int = 2 << 20, rows: int = 1 << 15) -> Iterator[Chunk]:
    """Split a string column (null: empty) into chunks of whole rows of about ``limit`` bytes."""
    n = len(column)
    if not n:
        return
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    bounds = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, "right")) - 1)
        b = min(b, n, a + rows)
        yield Chunk(a, b - a, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        a = b


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def words(c: Chunk, inside: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of bytes with ``inside``; none crosses a row."""
    w = inside[c.data]
    if not len(w):
        z = np.zeros(0, np.int64)
        return Words(z, z, z)
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    before[c.bounds[:-1][c.bounds[:-1] < len(w)]] = False
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    ends = c.bounds[1:]
    after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return Words(start, end, np.searchsorted(c.bounds, start, "right") - 1)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, from one running sum over the bytes."""
    run = np.empty(len(data) + 1, dtype=np.uint64)
    run[0] = 0
    np.cumsum(BYTE[data] * powers(len(data)), out=run[1:])
    return mix((run[end] - run[start]) * powers(len(data) + 1, "down")[start] + (end - start).astype(np.uint64))


def doc_ids(column: pa.Array) -> np.ndarray:
    """Integer ids; a null id counts as the largest."""
    return pc.fill_null(column.cast(pa.int64()), 2**63 - 1).to_numpy(zero_copy_only=False)


def by_group(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, positions in their order) for each value of a small non-negative integer key."""
    if not len(key):
        return
    order = np.argsort(key.astype(np.uint16) if key.max() < 65536 else key, kind="stable")
    k = key[order]
    cut = np.flatnonzero(np.diff(k)) + 1
    for part in np.split(order, cut):
        yield int(key[part[0]]), part


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... start + size - 1 of each pair, in one array."""
    ends = np.cumsum(size)
    index = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    index += np.repeat(start - (ends - size), size)
    return index


def pack56(x: np.ndarray) -> bytes:
    """Unsigned integers below 2**56, seven bytes each."""
    return x.astype("<u4").tobytes() + (x >> U(32)).astype("<u2").tobytes() + (x >> U(48)).astype(np.uint8).tobytes()


def unpack56(b: memoryview, n: int) -> np.ndarray:
    low, mid, high = np.frombuffer(b, "<u4", n), np.frombuffer(b, "<u2", n, 4 * n), np.frombuffer(b, np.uint8, n, 6 * n)
    return low.astype(np.uint64) | (mid.astype(np.uint64) << U(32)) | (high.astype(np.uint64) << U(48))


def pack40(x: np.ndarray) -> bytes:
    """Unsigned integers below 2**40, five bytes each."""
    return x.astype("<u4").tobytes() + (x >> U(32)).astype(np.uint8).tobytes()


def unpack40(b: memoryview, n: int) -> np.ndarray:
    low = np.frombuffer(b, "<u4", n).astype(np.uint64)
    return low | (np.frombuffer(b, np.uint8, n, 4 * n).astype(np.uint64) << U(32))
