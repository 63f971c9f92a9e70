"""Sets of keys as bitmaps of bounded size, to keep rows that cannot match out of a shuffle.

A key sets one bit of a bitmap that is cut into pages of 32,768 bits; the pages
are made by Spark's bitmap aggregates and are broadcast. A row whose bit is not
set is surely no member, the others are decided by an exact join. The size
follows the number of keys up to 64 MB and no further: beyond some 30 million
keys the bitmap lets more rows pass and the result stays exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.staging import BROADCAST_BYTES, staged

PAGE_BITS = 32_768
BITS_PER_KEY = 16
MAX_BITS = 8 * BROADCAST_BYTES


@dataclass(frozen=True)
class KeyFilter:
    """`bits` in all, and the pages: (page, bits of the page)."""

    bits: int
    pages: DataFrame

    def place(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.bits))


def key_filter(keys: DataFrame, key: str = "link_hash") -> KeyFilter:
    """The bitmap of a column; it is written, so that it can be used again. Runs jobs when called."""
    known = keys.filter(F.col(key).isNotNull()).select(key)
    bits = PAGE_BITS
    while bits < min(known.count() * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    empty = KeyFilter(bits, known)
    place = empty.place(F.col(key))
    pages = known.groupBy(F.bitmap_bucket_number(place).alias("_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    return KeyFilter(bits, staged(pages, "key-filter"))


def with_maybe(rows: DataFrame, known: KeyFilter, key: str = "link_hash", name: str = "maybe") -> DataFrame:
    """Add `name`: false where `key` is surely not in the filter. A null key is in no filter."""
    place = known.place(F.col(key))
    at = F.bitmap_bit_position(place)
    # MAX_BITS at most: broadcast.
    met = rows.join(F.broadcast(known.pages), F.bitmap_bucket_number(place) == F.col("_page"), "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return met.withColumn(name, F.coalesce(bit & F.col(key).isNotNull(), F.lit(False))).drop("_page", "_bits")


def members(rows: DataFrame, keys: DataFrame, known: KeyFilter, key: str = "link_hash") -> DataFrame:
    """Rows whose key is among `keys`: filtered where they are read, then joined exactly."""
    return with_maybe(rows, known, key, "_maybe").filter("_maybe").drop("_maybe").join(
        keys.select(key), key, "left_semi")


def strangers(rows: DataFrame, keys: DataFrame, known: KeyFilter, key: str = "link_hash") -> DataFrame:
    """Rows whose key is not among `keys`: only those that may be are moved."""
    marked = with_maybe(rows, known, key, "_maybe")
    unsure = marked.filter("_maybe").join(keys.select(key), key, "left_anti")
    return marked.filter("not _maybe").unionByName(unsure.select(*marked.columns)).drop("_maybe")
