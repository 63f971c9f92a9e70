"""I-Match fingerprints: terms of a middle document frequency, hashed over randomised lexicons.

The lexicon keeps the terms whose inverse document frequency lies in a band.
Of a text's distinct terms in it, each of many random subsets of the lexicon
takes those it holds, and their hash is one part of the fingerprint. Subsets
come at rates of 1/64, 1/128 and so on, 64 at each rate; a text uses the three
rates at which a subset holds about one of its terms or less, so that texts of
any length keep like shares of their parts when they are edited.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.spans import LOWER, hash_spans, mix, slices, words
from evenkeel.sources.staging import staged

# Places of the table of document frequencies; its error follows the number of texts, as the band does.
BITS = 22
# Natural logarithms of texts over texts with the term.
BAND = (2.3, 7.6)
# Subsets at a rate (a power of two), rates of a text, hexadecimal digits of a part.
SUBSETS, LEVELS, DIGITS = 64, 3, 4
LEAST = SUBSETS.bit_length() - 1
NONE = "none"
_SALT = 0x9E3779B97F4A7C15


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Which places of the table hold terms in the band, over all texts of `docs`.

    Runs jobs when called. Each task counts the distinct terms of its texts in
    one table of fixed size; the counts are added by place. A null text has no
    terms but counts as a text.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, texts = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, data, offsets in slices(batch.column(0)):
                terms, bounds = _terms(data, offsets)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) << BITS
                pairs = np.unique(doc | _place(terms))
                totals += np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(totals[used], texts))],
                                         ["place", "n"])

    counts = staged(docs.select("text").mapInArrow(tally, "place bigint, n bigint")
                    .groupBy("place").agg(F.sum("n").alias("n")), "document-frequencies")
    total = counts.filter("place < 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = counts.filter((F.col("place") >= 0) & F.col("n").between(
        float(total * np.exp(-band[1])), float(total * np.exp(-band[0]))))
    kept = np.zeros(1 << BITS, bool)
    kept[inside.select("place").toArrow().column("place").to_numpy()] = True
    return kept


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, end, first = words(data, offsets)
    return hash_spans(LOWER[data], begin, end), first


def _place(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - BITS)).astype(np.int64)


def fingerprint(text: Column, kept: np.ndarray) -> Column:
    """The fingerprint of a whole text as a string; equal texts have equal ones.

    A text without terms in the band uses all its terms; without any word, or
    null, it is `none`.
    """
    @F.arrow_udf("string")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(fingerprints(batch, kept), pa.string())

    return compute(text)


def fingerprints(texts: pa.Array, kept: np.ndarray) -> list[str]:
    out = []
    for _, data, offsets in slices(texts):
        terms, bounds = _terms(data, offsets)
        banded = kept[_place(terms)]
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = terms[lo:hi]
            inside = own[banded[lo:hi]]
            out.append(_print(np.unique(inside if len(inside) else own)))
    return out


def _print(terms: np.ndarray) -> str:
    """Level and parts of distinct terms; a subset without any of them has part 0."""
    if not len(terms):
        return NONE
    level = max(LEAST, len(terms).bit_length())
    sums = np.zeros(LEVELS * SUBSETS, np.uint64)
    held = np.zeros(LEVELS * SUBSETS, bool)
    value = mix(terms)
    for i in range(LEVELS):
        rate = level + i
        # Each rate deals the terms anew to 2^rate subsets, of which the first are used.
        subset = mix(terms ^ np.uint64(rate * _SALT % 2 ** 64)) >> np.uint64(64 - rate)
        used = subset < SUBSETS
        place = subset[used].astype(np.int64) + i * SUBSETS
        np.add.at(sums, place, value[used])
        held[place] = True
    parts = np.where(held, mix(sums) % np.uint64(16 ** DIGITS - 1) + np.uint64(1), np.uint64(0))
    return f"{level:02x}" + parts.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share, from 0 to 1, of their terms that two texts have in common, estimated from their parts.

    At a rate at which a subset holds `u` terms of either text on average, `y`
    of them in one text alone, a share exp(-u) of the subsets is empty in both
    and a share exp(-y) is alike. So the two shares give `u` and `y`, and
    2 (u - y) / (2 u - y) is what both hold of what each holds (Dice's measure).
    """
    if a == b:
        return 1.0
    if NONE in (a, b):
        return 0.0
    own, other = _levels(a), _levels(b)
    either = differing = 0.0
    for rate in own.keys() & other.keys():
        x, y = own[rate], other[rate]
        either -= log(max(np.count_nonzero((x == 0) & (y == 0)), 0.5) / SUBSETS)
        differing -= log(max(np.count_nonzero(x == y), 0.5) / SUBSETS)
    return 2 * (either - differing) / (2 * either - differing) if either else 0.0


def _levels(text: str) -> dict[int, np.ndarray]:
    parts = np.frombuffer(bytes.fromhex(text[2:]), ">u2").reshape(LEVELS, SUBSETS)
    return {int(text[:2], 16) + i: row for i, row in enumerate(parts)}


EDITS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


def edited(docs: DataFrame, kept: np.ndarray) -> DataFrame:
    """Fingerprints of each text, of its edit by the next text, and their likeness.

    The next document is that of the next smaller doc_id, a null one last; after
    the last comes the first. The edit replaces the last third of a text, in
    code points, by as many of the next one's first. Rows that repeat a doc_id
    follow each other by a hash of their text. A null text is empty.

    Texts move once: to ranges of doc_id, sorted inside a task that holds two
    texts at a time. The first text of a range goes to the range before it too.
    Runs jobs for the ranges when called. One document is its own next.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_id"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 8 * parts
    points = rows.agg(F.percentile_approx("_id", [(i + 1) / ranges for i in range(ranges)], 10_000)).first()[0]
    edges = np.unique(np.array(points or [], np.int64))
    ids = rows.select("_id", _range(edges)(F.col("_id")).alias("_range"))
    tops = {r["_range"]: r["top"] for r in ids.groupBy("_range").agg(F.max("_id").alias("top")).collect()}
    filled = sorted(tops)
    # The first of each range also ends the next higher one; the first of all ends the lowest.
    ends = {lower: higher for lower, higher in zip(filled, filled[1:] + filled[:1], strict=True)}
    targets = _targets(edges, tops, ends)
    moved = rows.withColumn("_to", F.explode(targets(F.col("_id")))).select(
        "doc_id", "text", F.shiftright("_to", 1).alias("_range"), F.col("_to").bitwiseAND(F.lit(1)).alias("_guest"))
    placed = (moved.repartition(parts, "_range")
              .sortWithinPartitions("_range", "_guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")))
    return placed.mapInArrow(_edit_rows(kept), EDITS)


def _range(edges: np.ndarray):
    @F.arrow_udf("bigint")
    def compute(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, ids.to_numpy(zero_copy_only=False)).astype(np.int64))

    return compute


def _targets(edges: np.ndarray, tops: dict[int, int], ends: dict[int, int]):
    @F.arrow_udf("array<bigint>")
    def compute(ids: pa.Array) -> pa.Array:
        values = ids.to_numpy(zero_copy_only=False)
        own = np.searchsorted(edges, values).tolist()
        out = [[2 * r, 2 * ends[r] + 1] if tops[r] == v else [2 * r] for r, v in zip(own, values.tolist(), strict=True)]
        return pa.array(out, pa.list_(pa.int64()))

    return compute


def _edit_rows(kept: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # (doc_id, text, fingerprint, range) whose next text is still to come
        for batch in batches:
            texts = batch.column(1).to_pylist()
            prints = fingerprints(batch.column(1), kept)
            done = []
            for doc_id, text, place, guest, own in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(),
                                                       batch.column(3).to_pylist(), prints, strict=True):
                if waiting and waiting[3] == place:
                    third = len(waiting[1]) // 3
                    done.append((*waiting[:3], waiting[1][:len(waiting[1]) - third] + text[:third], own))
                waiting = None if guest else (doc_id, text, own, place)
            yield _edit_batch(done, kept)

    return run


def _edit_batch(done: list[tuple], kept: np.ndarray) -> pa.RecordBatch:
    changed = fingerprints(pa.array([row[3] for row in done], pa.string()), kept)
    columns = [
        pa.array([row[0] for row in done], pa.int64()),
        pa.array([len(row[1]) for row in done], pa.int64()),
        pa.array([sha256(row[3].encode()).hexdigest() for row in done], pa.string()),
        pa.array([row[2] for row in done], pa.string()),
        pa.array(changed, pa.string()),
        pa.array([likeness(row[2], other) for row, other in zip(done, changed, strict=True)], pa.float64()),
        pa.array([likeness(row[2], row[4]) for row in done], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in EDITS.split(", ")])
