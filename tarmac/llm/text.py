"""Whole-text helpers for tasks: Arrow batches of texts to word positions and
hashes with numpy, without a Python object per word.

A word is a maximal run of bytes other than ASCII white space (0x09-0x0D and
0x20); a null text counts as empty. Hashes are 64-bit: a polynomial over the
bytes (or over word hashes, for windows) modulo 2**64, then mixed. Two given
strings get one hash with a chance of about 2**-64.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of letter-like runs: ASCII letters, digits, apostrophe and every byte
# of a character beyond ASCII; the rest separates.
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[39, *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

SLICE_BYTES = 1 << 21   # texts handled together in a task
BLOCK = 1 << 18         # bytes or words hashed together


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    name = "_tarmac_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer; a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of ``base`` and of its inverse modulo 2**64."""
    cache = worker_cache()
    key = f"powers{base}"
    if key not in cache or len(cache[key][0]) <= n:
        size = 1 << max(19, int(n).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        cache[key] = tuple(tables)
    return cache[key]


BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD95


def _span_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """sum(values[i] * base**(i - start)) over each span, modulo 2**64."""
    up, down = _powers(base, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; spans are ordered and disjoint."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + BLOCK, side="right")))
        part = data[at : ends[j - 1]].astype(np.uint64)
        part += np.uint64(1)
        out[i:j] = _span_sums(part, BYTE_BASE, starts[i:j] - at, ends[i:j] - at)
        i = j
    return mix(out)


def hash_windows(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every k consecutive word hashes (len(words) - k + 1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for at in range(0, n, BLOCK):
        m = min(BLOCK, n - at)
        first = np.arange(m)
        out[at : at + m] = _span_sums(words[at : at + m + k - 1], WORD_BASE, first, first + k)
    return mix(out)


class Texts(NamedTuple):
    """Some rows of a batch: their bytes, offsets and place in the batch."""

    data: np.ndarray     # uint8
    offsets: np.ndarray  # int64, rows + 1
    start: int           # first row in the batch
    stop: int


class Words(NamedTuple):
    start: np.ndarray    # byte positions
    end: np.ndarray
    first: np.ndarray    # index of each row's first word, rows + 1
    hash: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Consecutive rows with at most ``limit`` bytes together, or one row."""
    data, off = byte_view(column)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield Texts(data[off[i] : off[j]], off[i : j + 1] - off[i], i, j)
        i = j


def bounds(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows (a word ends with its row)."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    out = sep[data]
    inside = ~out
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= out[:-1]
    end[:-1] &= out[1:]
    first, last = offsets[:-1], offsets[1:] - 1
    first = first[first < len(data)]
    last = last[last >= 0]
    begin[first] = inside[first]
    end[last] = inside[last]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def words_of(t: Texts, lower: bool = False, sep: np.ndarray = SPACE) -> Words:
    start, end = bounds(t.data, t.offsets, sep)
    data = LOWER[t.data] if lower else t.data
    return Words(start, end, np.searchsorted(start, t.offsets), hash_spans(data, start, end))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    step = np.ones(total, dtype=np.int64)
    at = np.cumsum(lengths)[:-1]
    step[0] = starts[0]
    step[at] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(step)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow binary array."""
    lengths = ends - starts
    off = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=off[1:])
    body = data[ragged(starts, lengths)] if len(starts) else np.zeros(0, dtype=np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(body))])


def count_pairs(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of each array of counts."""
    if not len(keys):
        return (keys, *counts)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return (k[at], *(np.add.reduceat(c[order], at) for c in counts))


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, in order, and the number among them of each value (uint32),
    with half the memory that ``np.unique`` takes if the caller keeps no ``values``."""
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    values = values[new]
    number = np.cumsum(new, dtype=np.uint32)
    number -= np.uint32(1)
    out = np.empty_like(number)
    out[order] = number
    return values, out


def cut_by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers that occur and the bounds of each in ``keys``, which are
    sorted; a bucket is an equal range of the 64-bit keys."""
    b = bucket_of(keys, buckets)
    at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, dtype=np.int64)
    return b[at], np.append(at, len(b))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def rows(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
