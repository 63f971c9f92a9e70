"""Words and character windows of whole texts, hashed with numpy inside a task.

A batch of texts is cut into slices of about half a megabyte, so that the memory of
a task follows the slice (or the longest single text), never the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
# White space is what `[\x20\x09-\x0D]` matches.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's iterator that gives its memory back at the end: Spark keeps the worker for other stages."""
    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return task


def release() -> None:
    """Empty what this module keeps, and return freed memory to the system where the C library can."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(places, places[row] + limit, "right")) - 1)
        yield row, data[places[row]:places[end]], places[row:end + 1] - places[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's first word (one entry more than texts)."""
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = offsets[:-1] < offsets[1:]
    starts, ends = offsets[:-1][full], offsets[1:][full] - 1
    first[starts], last[ends] = solid[starts], solid[ends]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: equal bytes give equal hashes, wherever they stand."""
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin])


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) <= size:
        size = max(SLICE_BYTES + (1 << 16), size + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `values` between consecutive bounds, added in order inside each range alone."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(bounds[:-1] < bounds[1:])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full], dtype=np.float64)
    return out
