"""Texts of an Arrow batch as flat numpy arrays: bytes, words and hashes of runs.

Everything works on a slice of a batch with a bounded number of bytes (a longer
document is a slice of its own), so memory follows the slice, not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000


def release() -> None:
    """Give freed memory back. A Python worker lives on from task to task, and what its
    allocators keep of one stage is missing in the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc
        trim(0)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; null counts as empty."""
    if not len(texts):
        return
    release()
    flat = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    offsets = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(flat):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, len(flat))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def run_hashes(units: np.ndarray, length: int, salt: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` units from every place that has as many.

    Doubling: a run of 2n is the pair of its halves; a length between two powers is
    covered by two overlapping runs.
    """
    h, n = mix(units.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64 | 1)), 1
    while n * 2 <= length:
        h = mix(h[:-n] * np.uint64(0xA0761D6478BD642F) + h[n:]) if len(h) > n else h[:0]
        n *= 2
    if n < length:
        gap = length - n
        h = mix(h[:-gap] * np.uint64(0xE7037ED1A0B428DB) + h[gap:]) if len(h) > gap else h[:0]
    return h


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of the ``width`` values from every place."""
    n = 1
    while n * 2 <= width:
        values = pick(values[:-n], values[n:]) if len(values) > n else values[:0]
        n *= 2
    if n < width:
        gap = width - n
        values = pick(values[:-gap], values[gap:]) if len(values) > gap else values[:0]
    return values


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every row (one more
    than rows). A word is a run of bytes other than space and 0x09 to 0x0D."""
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = ~SPACES[data]
    inside[-1] = False
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True  # words end with their row
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks))
    ends = np.flatnonzero(before & (~inside | breaks))
    return starts, ends, np.searchsorted(starts, offsets)


def range_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of every byte range: its blocks of eight bytes, mixed one by one."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    block_at = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h = mix(lengths.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64 | 1))
    at, left, rows = starts, lengths, None
    while len(at):
        short = left < 8
        block = block_at[at]
        block[short] &= MASKS[left[short]]
        if rows is None:
            h = mix((h ^ block) * np.uint64(0xA0761D6478BD642F))
        else:
            h[rows] = mix((h[rows] ^ block) * np.uint64(0xA0761D6478BD642F))
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


MASKS = np.array([(1 << 8 * i) - 1 for i in range(8)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    return range_hashes(data, starts, ends - starts, salt)


def unit_range_hashes(units: np.ndarray, starts: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
    """``range_hashes`` over 64-bit units such as word hashes."""
    h = mix(lengths.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64 | 1))
    for i in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > i)
        h[rows] = mix((h[rows] ^ units[starts[rows] + i]) * np.uint64(0xA0761D6478BD642F))
    return h


def short_runs(units: np.ndarray, length: int) -> np.ndarray:
    """``run_hashes`` with 32 bits: enough to choose a place, not to tell runs apart."""
    h, n = units.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x85EBCA6B), 1
    h ^= h >> np.uint32(15)
    while n < length:
        gap = min(n, length - n)
        if len(h) <= gap:
            return h[:0]
        h = h[:-gap] * np.uint32(0x9E3779B1) + h[gap:]
        h ^= h >> np.uint32(15)
        n += gap
    return h * np.uint32(0x2C1B3C6D)
