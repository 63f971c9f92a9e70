"""SimHash near-duplicates by an inverted index of positional bytes.

A fingerprint has a bit for each of 64 hash bits (times `planes`): 1 if the bit
is set in more than half of the document's shingle hashes. Two fingerprints of
B bytes that differ in at most k bits share at least B - k bytes at their
positions. The index lists documents by the bytes of two groups of positions at
once: lists of one byte hold a 256th of all rows each, so that their pairs
grow with the square of the table. For each pair met in a list the shared
positional bytes are tallied; pairs below the minimum go, the rest are verified
bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.spans import LOWER, lean, mix, slices, words
from evenkeel.sources.staging import staged

HASH_SEED = 42
# Shingles whose hashes are counted at a time.
BLOCK = 1 << 15
# Parts of a list that have a star each.
STAR_PARTS = 16
_PLANE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Index:
    """How pairs are found: the positions of each list, shared bytes asked for, bits that may differ."""

    positions: tuple[tuple[int, ...], ...]
    min_shared: int
    max_bits: int


def exact_index(max_bits: int, size: int = 8) -> Index:
    """Every pair at `max_bits` or fewer: one list per pair of groups of positions.

    Positions stand in `max_bits` + 2 groups, of which that many differing bits
    leave two alike at least, so the two meet in a list. They share `size` -
    `max_bits` bytes or more; a pair that merely meets is turned away by the
    tally. For two bits these are six lists of four bytes each.
    """
    groups = np.array_split(np.arange(size), max_bits + 2)
    lists = tuple(tuple(int(p) for p in (*a, *b)) for a, b in combinations(groups, 2))
    return Index(lists, size - max_bits, max_bits)


def fingerprint(text: Column, shingle: int, planes: int = 1) -> Column:
    """Fingerprint of a whole text as an array of `planes` longs.

    Upper-case A-Z is lowered, words are split at ASCII white space. Fewer
    words than `shingle` make one shingle; a text without words, or null, has
    the fingerprint zero. Repeated shingles count as often as they occur.
    """
    @F.arrow_udf("array<bigint>")
    @lean
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fp for _, data, offsets in slices(batch)
                     for fp in _fingerprints(data, offsets, shingle, planes)]
            flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
            ends = np.arange(len(found) + 1, dtype=np.int32) * planes
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))

    return compute(text)


def _hashed(data: np.ndarray, offsets: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of each text's shingles as they stand; a text without words has none."""
    begin, end, first = words(data, offsets)
    # Words with one space between them: a shingle is then one slice of bytes.
    sizes = end - begin
    place = np.concatenate([[0], np.cumsum(sizes + 1)])
    target = np.full(int(place[-1]), 0x20, np.uint8)
    solid = np.ones(len(target), bool)
    solid[place[1:] - 1] = False
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begin] += 1
    inside[end] -= 1
    target[solid] = LOWER[data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]]
    raw = target.tobytes()
    for doc in range(len(offsets) - 1):
        lo, hi = int(first[doc]), int(first[doc + 1])
        if lo == hi:
            yield np.zeros(0, np.uint64)
            continue
        count = max(1, hi - lo - shingle + 1)
        starts = place[lo:lo + count].tolist()
        stops = (place[hi - count + 1:hi + 1] - 1).tolist()
        yield np.array([xxhash.xxh64_intdigest(raw[s:e], HASH_SEED)
                        for s, e in zip(starts, stops, strict=True)], np.uint64)


def _bits(hashes: np.ndarray, planes: int) -> np.ndarray:
    """The fingerprint of shingle hashes: zero if there are none."""
    bits = np.zeros((planes, 64), np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK]
        for plane in range(planes):
            turned = block if plane == 0 else mix(block + np.uint64(int(_PLANE) * plane % 2 ** 64))
            each = np.unpackbits(turned.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits[plane] += each.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * bits > len(hashes), axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int, planes: int) -> list[np.ndarray]:
    return [_bits(hashes, planes) for hashes in _hashed(data, offsets, shingle)]


def byte_at(fp: str, position: int) -> Column:
    word = F.col(fp)[position // 8]
    return F.shiftrightunsigned(word, 8 * (position % 8)).bitwiseAND(F.lit(255))


def _list_key(fp: str, positions: tuple[int, ...]) -> Column:
    """Up to seven bytes of a fingerprint in one long."""
    parts = [F.shiftleft(byte_at(fp, p), 8 * i) for i, p in enumerate(positions)]
    key = parts[0]
    for part in parts[1:]:
        key = key.bitwiseOR(part)
    return key


def shared_bytes(a: str, b: str, planes: int) -> Column:
    """How many positional bytes two fingerprints share."""
    ones = 0x0101010101010101
    parts = []
    for i in range(planes):
        bits = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for step in (4, 2, 1):  # the lowest bit of each byte tells whether any of its bits differs
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step).bitwiseAND(F.lit(ones * (256 // 2 ** step - 1))))
        parts.append(8 - F.bit_count(bits.bitwiseAND(F.lit(ones))))
    return _total(parts)


def differing_bits(a: str, b: str, planes: int) -> Column:
    return _total([F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(planes)])


def _met_before(index: Index, a: str, b: str) -> Column:
    """True if two fingerprints share a list before the one they meet in; few pairs come to this test."""
    differ = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    masks = []
    for positions in index.positions:
        words = sorted({p // 8 for p in positions})
        bits = [sum(255 << 8 * (p % 8) for p in positions if p // 8 == w) for w in words]
        signed = [m - (1 << 64) if m >> 63 else m for m in bits]
        masks.append(F.array(*[F.struct(F.lit(w + 1).alias("word"), F.lit(m).cast("bigint").alias("mask"))
                               for w, m in zip(words, signed, strict=True)]))
    earlier = F.slice(F.array(*masks), F.lit(1), F.col("list"))
    return F.exists(earlier, lambda held: F.forall(
        held, lambda m: F.element_at(differ, m["word"]).bitwiseAND(m["mask"]) == 0))


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = add(out, part)
    return out


def _listed(prints: DataFrame, index: Index) -> DataFrame:
    """A row for each list that a fingerprint stands in."""
    lists = [F.struct(F.lit(i).alias("list"), _list_key("fp", p).alias("key"))
             for i, p in enumerate(index.positions)]
    return prints.withColumn("_at", F.explode(F.array(*lists))).select(*prints.columns, "_at.list", "_at.key")


def star_pairs(distinct: DataFrame, index: Index, planes: int = 1) -> DataFrame:
    """(a, b): links of fingerprints with the first one of their list, at most one a row.

    `distinct` has (id, fp), one row per fingerprint. A list is dealt over
    `STAR_PARTS` tasks by id, each part with a first one of its own, so that a
    very large group ties itself together by a number of links that follows
    its size.
    """
    rows = _listed(distinct, index).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(STAR_PARTS)))
    part = Window.partitionBy("list", "key", "part").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    first = rows.withColumn("centre", F.first(F.struct("id", "fp")).over(part)).select(
        F.col("id").alias("a"), F.col("fp").alias("fa"), F.col("centre.id").alias("b"), F.col("centre.fp").alias("fb"))
    return first.filter((F.col("a") != F.col("b")) & _near(index, planes)).select("a", "b")


def met_pairs(distinct: DataFrame, index: Index, planes: int = 1) -> DataFrame:
    """(list, a, fa, ga, b, fb, gb): what meets in the lists, of different groups only.

    `distinct` has (id, fp), one row per fingerprint, and may have `group`, else
    each is one. Lists of one group alone, as nearly all are, go first. In the
    others the rows of all groups but the largest meet the whole list, so that
    the mates of a large group are never compared with each other. The join is
    on the list and its key alone, so Spark can split a large list between
    tasks.
    """
    grouped = distinct if "group" in distinct.columns else distinct.withColumn("group", F.col("id"))
    rows = _listed(grouped.select("id", "fp", "group"), index)
    sizes = rows.groupBy("list", "key", "group").agg(F.count(F.lit(1)).alias("n"))
    held = sizes.groupBy("list", "key").agg(F.max(F.struct("n", "group"))["group"].alias("main"),
                                            F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    met = staged(rows.join(held, ["list", "key"]).select(*rows.columns, "main"), "simhash-lists")
    one = met.filter(F.col("group") != F.col("main")).select(
        "list", "key", "main", F.col("id").alias("a"), F.col("fp").alias("fa"), F.col("group").alias("ga"))
    two = met.select("list", "key", F.col("id").alias("b"), F.col("fp").alias("fb"), F.col("group").alias("gb"))
    once = (F.col("gb") == F.col("main")) | (F.col("a") < F.col("b"))
    return one.join(two, ["list", "key"]).filter((F.col("ga") != F.col("gb")) & once).drop("key", "main")


def link_pairs(distinct: DataFrame, index: Index, planes: int = 1) -> DataFrame:
    """(a, b, ga, gb): ids of fingerprints of different groups that differ in at most `max_bits` bits, each pair once.

    Of the pairs that meet (`met_pairs`) the tally keeps those with the
    guaranteed number of shared bytes; their bits decide. A pair is emitted in
    the first list that it shares. Runs a job when called.
    """
    met = met_pairs(distinct, index, planes)
    return met.filter(_near(index, planes) & ~_met_before(index, "fa", "fb")).select("a", "b", "ga", "gb")


def _near(index: Index, planes: int) -> Column:
    """The tally of shared bytes and the check of bits for columns `fa` and `fb`."""
    return ((shared_bytes("fa", "fb", planes) >= index.min_shared)
            & (differing_bits("fa", "fb", planes) <= index.max_bits))


def near_duplicates(docs: DataFrame, shingle: int, index: Index, planes: int = 1,
                    also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that links reach, itself included.

    Runs jobs when called; what it writes is a fingerprint per document. Documents
    with one fingerprint are linked through the smallest of them, so a group
    of copies of any size is one row of the index. Large groups of near copies
    are tied together by stars first; after that all links between the groups
    are searched, so that no group's pairs are ever listed. Rows that repeat a doc_id
    stay and share its component if their texts are alike; a null doc_id
    links with nothing and gets a null component. Columns of `docs` other than
    doc_id and text are not used; those named in `also`, narrow ones, are carried
    along. No rows give no rows.
    """
    prints = staged(docs.select("doc_id", *also, fingerprint(F.col("text"), shingle, planes).alias("fp")), "simhash")
    known = prints.filter(F.col("doc_id").isNotNull())
    distinct = staged(known.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-distinct")
    tied = components(star_pairs(distinct, index, planes))
    grouped = staged(distinct.join(tied, F.col("id") == F.col("node"), "left")
                     .select("id", "fp", F.coalesce("component", "id").alias("group")), "simhash-groups")
    joined = components(link_pairs(grouped, index, planes), "ga", "gb")
    roots = staged(grouped.join(joined, F.col("group") == F.col("node"), "left")
                   .select("fp", F.coalesce("component", "group").alias("component_id")), "simhash-roots")
    found = prints.join(roots, "fp", "left")
    return found.select("doc_id", "fp", *also, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
                        .alias("component_id"))


def hex_fingerprint(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)[0]), 16, "0"))
