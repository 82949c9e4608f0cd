"""Words of whole texts as 64-bit hashes, computed batch-wise on Arrow buffers.

A word is a maximal run of bytes other than ``0x20`` and ``0x09-0x0D``. All
functions work on the UTF-8 buffers of an Arrow string column, so a batch of
documents costs a fixed number of numpy passes and no per-word Python.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64)
_SEGMENT = 1 << 20
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (the odd base is invertible)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SEGMENT + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            tables = []
            for base in (_BASE, inverse):
                t = np.full(size, np.uint64(base), dtype=np.uint64)
                t[0] = 1
                tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def _range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each range, by prefix sums."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


@dataclass
class Words:
    """Words of a batch: hashes, byte ranges in ``data`` and, per document, the
    index of its first word (``first`` has one entry more than documents)."""

    data: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets; null counts as ''."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def batch_words(texts: pa.Array, fold_case: bool = False) -> Words:
    """Words of every text of the column. ``fold_case`` lower-cases A-Z only."""
    data, off = text_buffers(texts)
    if fold_case:
        data = fold_ascii(data)
    start, end, first = word_spans(data, off)
    return Words(data, hash_ranges(data, start, end), start, end, first)


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _FOLD[data]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of the words of texts that lie at ``off`` in ``data``, and the
    index of each text's first word (one entry more than texts)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(off), np.int64)
    space = _SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    before[off[:-1][off[:-1] < n]] = True
    after[off[1:][off[1:] > 0] - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return start, end, np.searchsorted(start, off)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range (ascending, not overlapping)."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(start):  # segments of about 1 MB bound the working memory
            j = max(i + 1, int(np.searchsorted(end, start[i] + _SEGMENT, side="right")))
            lo, hi = start[i], end[j - 1]
            h = _range_hash(_BYTE[data[lo:hi]], start[i:j] - lo, end[i:j] - lo)
            out[i:j] = mix64(h + (end[i:j] - start[i:j]).astype(np.uint64) * np.uint64(_BASE))
            i = j
    return out


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows inside one document, and the index of
    each window's first word (ascending)."""
    h, n = words.hashes, words.counts()
    at = window_starts(words.first, size)
    if len(at) == 0:
        return np.zeros(0, np.uint64), at
    with np.errstate(over="ignore"):
        return mix64(_range_hash(h, at, at + size) + np.uint64(size)), at


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Word indexes at which a window of ``size`` words of one document starts."""
    total = int(first[-1])
    ok = np.ones(total, dtype=bool)
    n = np.diff(first)
    tail = np.minimum(n, size - 1)
    last = np.repeat(first[1:], tail) - 1 - (np.arange(int(tail.sum())) - np.repeat(np.cumsum(tail) - tail, tail))
    ok[last] = False
    return np.flatnonzero(ok)


def sequence_hash(hashes: np.ndarray) -> int:
    """Hash of a whole word sequence (same function as a window of its length)."""
    with np.errstate(over="ignore"):
        h = _range_hash(hashes, np.array([0]), np.array([len(hashes)]))
        return int(mix64(h + np.uint64(len(hashes)))[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows of at most ``max_bytes`` of text (one
    row may be longer), so numpy temporaries do not grow with the batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_buffers(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            yield batch.slice(i, j - i)
            i = j


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: Python workers
    live on for later stages, and an executor's memory is counted as a whole."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
