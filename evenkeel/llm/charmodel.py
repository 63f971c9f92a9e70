"""A character language model, counted over every text of a table.

Texts are lowered and all but letters become space; windows of two, three and
four bytes are counted in tables of fixed size, so that the model's size does
not follow the corpus while its counts do.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.spans import slices

# Bits of the tables for two, three and four bytes; windows of two have a place each.
BITS = (16, 18, 20)
STARTS = (0, 1 << 16, (1 << 16) + (1 << 18))
SIZE = STARTS[2] + (1 << 20)
_TURN = 0x9E3779B1
# Bytes that are counted at a time; more than the largest table has places.
SLICE = 1 << 22
# Weight of the shorter window, in counts.
BACK_OFF = 2.0
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def place(window: int, order: int) -> int:
    """Place of a window whose last byte is the lowest."""
    if order == 2:
        return window
    return STARTS[order - 2] + (window * _TURN % 2 ** 32 >> 32 - BITS[order - 2])


def count_windows(data: np.ndarray, offsets: np.ndarray, totals: np.ndarray) -> None:
    """Add the windows of lowered texts to `totals`; three spaces stand between texts."""
    sizes = np.diff(offsets)
    padded = np.full(len(data) + 3 * (len(sizes) + 1), 0x20, np.uint8)
    padded[np.arange(len(data)) + np.repeat(3 * np.arange(1, len(sizes) + 1), sizes)] = np.where(
        _LETTER[data], data, 0x20)
    solid = padded != 0x20
    ends = np.flatnonzero(solid[3:] | solid[2:-1]) + 3
    window = padded[ends].astype(np.uint32)
    for back in (1, 2, 3):
        window = window | (padded[ends - back].astype(np.uint32) << np.uint32(8 * back))
        bits, start = BITS[back - 1], STARTS[back - 1]
        found = window if back == 1 else (window * np.uint32(_TURN)) >> np.uint32(32 - bits)
        totals[start:start + (1 << bits)] += np.bincount(found, minlength=1 << bits)


def count(docs: DataFrame) -> np.ndarray:
    """Counts over all texts of `docs`; runs a job that returns one row per place, `SIZE` at most."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(SIZE, np.int64)
        for batch in batches:
            for _, data, offsets in slices(pc.utf8_lower(pc.fill_null(batch.column(0), "")), SLICE):
                count_windows(data, offsets, totals)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["place", "n"])

    counted = docs.select("text").mapInArrow(tally, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    totals = np.zeros(SIZE, np.int64)
    totals[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return totals


class CharModel:
    """Logarithms of the probability of a byte after up to three others."""

    def __init__(self, totals: np.ndarray):
        self.totals = totals
        pairs = totals[:1 << 16].reshape(256, 256)
        self.before, self.single = pairs.sum(axis=1).tolist(), pairs.sum(axis=0).tolist()
        self.sum = max(sum(self.single), 1)
        self.known = Costs(self)

    def cost(self, last: int, byte: int) -> float:
        """Minus log probability of `byte` after the three bytes of `last`."""
        return self.known[(last & 0xFFFFFF) << 8 | byte]

    def of(self, window: int) -> float:
        """Minus log probability of the last of four bytes."""
        n = self.totals.item
        byte, two, three = window & 0xFF, window & 0xFFFF, window & 0xFFFFFF
        p = (self.single[byte] + 0.1) / (self.sum + 25.6)
        p = (n(two) + BACK_OFF * p) / (self.before[two >> 8] + BACK_OFF)
        found = n(place(three, 3))
        p = (found + BACK_OFF * p) / (max(found, n(three >> 8)) + BACK_OFF)
        found = n(place(window, 4))
        p = (found + BACK_OFF * p) / (max(found, n(place(window >> 8, 3))) + BACK_OFF)
        return -log(p)


class Costs(dict):
    """Window of four bytes to the cost of its last, counted once."""

    def __init__(self, model: CharModel):
        super().__init__()
        self.model = model

    def __missing__(self, window: int) -> float:
        found = self[window] = self.model.of(window)
        return found
