"""Words and their hashes for whole batches of texts, as numpy arrays.

A word is a longest run of bytes that are none of space and 0x09-0x0D; ASCII letters
count as lower case.  A batch is one byte buffer, so no word becomes a Python object.
"""
from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from pathlib import Path
from types import ModuleType

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK_BYTES = 1 << 19  # arrays of a piece fit a core's cache
_BASE = 0x9E3779B97F4A7C15


def _tables() -> dict:
    """A cache of the process: code that is sent by value would bring a new one with every task."""
    return sys.modules.setdefault("_assayframe_word_tables", ModuleType("_assayframe_word_tables")).__dict__


def tidy() -> None:
    """Give memory back to the system.

    Python workers outlive their tasks; what a task has freed would stay in the allocators
    of several idle workers, and sent code and its globals are cycles.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def one_thread() -> None:
    """Let numpy's matrix products use one thread: a task has one core, and idle threads spin."""
    if "one_thread" in _tables():
        return
    _tables()["one_thread"] = True
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_",
                     "openblas_set_num_threads"):
            try:
                getattr(ctypes.CDLL(str(path)), name)(1)
                return
            except (AttributeError, OSError):
                continue


def tidied(task: Callable) -> Callable:
    """A task over batches that gives its memory back at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        tidy()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values over all bits (xor-shift and multiply, one to one)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base modulo 2^64, and of its inverse."""
    tables = _tables()
    if "p" not in tables or len(tables["p"]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            tables[name] = np.multiply.accumulate(steps)
    return tables["p"], tables["q"]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and len + 1 offsets; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if len(at) == 0:
        at = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes; a longer text stands alone."""
    if batch.num_rows == 0:
        return
    _, at = texts_of(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def _classes(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, bool)
    is_word[list(SPACES)] = False
    value = np.arange(256, dtype=np.uint64) + np.uint64(1)
    if lower:
        value[65:91] += np.uint64(32)
    return is_word, value


def word_spans(data: np.ndarray, at: np.ndarray,
               members: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the row it belongs to.

    ``members`` says for each of the 256 bytes whether it can be part of a word.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = (_classes(True)[0] if members is None else members)[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    joined = cuts[inside[cuts] & inside[cuts + 1]]
    starts[joined] = True
    ends[joined] = True
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    row = np.searchsorted(at, first, "right") - 1
    return first, last, row


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes that depends on its content alone."""
    p, q = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_classes(lower)[1][data] * p[:len(data)], out=total[1:])
    return mix64((total[last] - total[first]) * q[first] + (last - first).astype(np.uint64))


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a column of texts."""
    data, at = texts_of(column)
    first, last, row = word_spans(data, at)
    return span_hashes(data, first, last, lower), row


def shingles(words: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, with rows; a shorter text is one shingle."""
    rng = np.random.default_rng(7)
    factor = rng.integers(1 << 62, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(words)
    total = np.zeros(n, np.uint64)
    same = np.ones(n, bool)
    for k in range(size):
        if k == 0:
            total += words * factor[0]
            continue
        shifted = np.zeros(n, np.uint64)
        inside = np.zeros(n, bool)
        if n > k:
            inside[:-k] = row[k:] == row[:-k]
            shifted[:-k] = words[k:]
        total += np.where(inside, shifted * factor[k], np.uint64(0))
        same = inside if k == size - 1 else same
    begins = np.ones(n, bool)
    begins[1:] = row[1:] != row[:-1]
    keep = same | (begins & ~same)
    if size == 1:
        keep = np.ones(n, bool)
    return mix64(total[keep]), row[keep]


def row_starts(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin in the sorted array ``row``, and the total at the end."""
    return np.searchsorted(row, np.arange(rows + 1))


def sets_of(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in rising order, with offsets."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, row_starts(row, rows)
