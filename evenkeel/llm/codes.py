"""Vector code compression: product codebooks over whole numbers, distances by value dictionaries.

Vectors are cut into parts, and each part is named by the nearest of the
entries of its codebook. Rows are first written as blocks: for each dimension a
dictionary of the distinct integers and a code per vector. The squared
differences of every distinct integer to all entries are tabulated once per
block, so that a part's distances are gathers of table rows, added up over its
dimensions. A round is one pass over the blocks; what goes to the driver is the
sums of the entries, the size of the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.vectors import finite, matrix, whole, with_totals
from evenkeel.sources.staging import staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
# Vectors of a block at most.
BLOCK = 4_096

BLOCKS = "ids array<bigint>, labels array<int>, dictionaries array<array<int>>, codes binary"
SUMS = "entry int, place int, n bigint, total bigint"
CODED = "vec_id bigint, label int, code string, error bigint"


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector without a null or non-finite component.

    `vectors` has vec_id, embedding and label; other columns are ignored and
    null vectors go. A code has two hex digits a part. Rows that repeat a
    vec_id or a vector are coded each; a null vec_id is coded and starts no
    codebook unless fewer others than `entries` are there. Vectors shorter
    than the longest count as filled up with zeros, and the length is rounded
    up to a multiple of `parts`. Integers are held within plus and minus 2 **
    26. With fewer rows than `entries` the codebooks are as many entries long.
    `label_error` is null if it does not fit a long. Runs jobs when called; no
    rows give no rows.
    """
    kept = vectors.select("vec_id", "embedding", F.col("label").cast("int").alias("label")).filter(finite("embedding"))
    longest = kept.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    width = -(-longest // parts) * parts
    blocks = staged(_blocks(kept, width), "vector-blocks")
    book = first_entries(kept, width, entries)
    for _ in range(rounds):
        book = moved(book, blocks, parts)
    coded = staged(_coded(blocks, book, parts), "vector-codes")
    errors = coded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    return with_totals(coded, errors, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(book, parts)).alias("codebooks_sha256"))


def first_entries(kept: DataFrame, width: int, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, a row each: `entries` rows at most."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding"), F.col("label")]
    rows = kept.orderBy(*order).limit(entries).select("embedding").collect()
    column = pa.array([r[0] for r in rows], pa.list_(pa.float64()))
    return whole(matrix(column, width)) if rows else np.zeros((0, width), np.int64)


def digest(book: np.ndarray, parts: int) -> str:
    """SHA-256 of all entries' components by part, entry and place within the part."""
    by_part = book.reshape(len(book), parts, -1).transpose(1, 0, 2) if book.size else book
    return hashlib.sha256(",".join(map(str, by_part.reshape(-1).tolist())).encode()).hexdigest()


def encode(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each dimension the distinct integers, and where each vector's stands among them."""
    found = [np.unique(x[:, d], return_inverse=True) for d in range(x.shape[1])]
    codes = np.array([code.reshape(-1) for _, code in found], np.uint16).reshape(x.shape[1], len(x))
    return [values for values, _ in found], codes


def assign(dictionaries: list[np.ndarray], codes: np.ndarray, book: np.ndarray,
           parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry of each part and vector, error of each vector); of equally near entries the first."""
    size, n = len(codes) // parts, codes.shape[1]
    nearest, error = np.zeros((parts, n), np.int64), np.zeros(n, np.int64)
    for part in range(parts):
        distance = np.zeros((n, len(book)), np.int64)
        for d in range(part * size, (part + 1) * size):
            table = (dictionaries[d][:, None] - book[None, :, d]) ** 2
            distance += table[codes[d]]
        nearest[part] = distance.argmin(axis=1)
        error += distance[np.arange(n), nearest[part]]
    return nearest, error


def sums(dictionaries: list[np.ndarray], codes: np.ndarray, nearest: np.ndarray,
         entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sum of their integers) of each entry and dimension: counts of codes times the dictionary."""
    size = len(codes) // len(nearest)
    n, total = np.zeros((entries, len(codes)), np.int64), np.zeros((entries, len(codes)), np.int64)
    for d, values in enumerate(dictionaries):
        cells = np.bincount(nearest[d // size] * len(values) + codes[d], minlength=entries * len(values))
        cells = cells.reshape(entries, len(values)).astype(np.int64)
        n[:, d], total[:, d] = cells.sum(axis=1), cells @ values
    return n, total


def moved(book: np.ndarray, blocks: DataFrame, parts: int) -> np.ndarray:
    """The entries after one round: floor(sum / count) of their vectors' parts; an unused entry stays."""
    entries, width = book.shape
    if not book.size:
        return book

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((entries, width), np.int64), np.zeros((entries, width), np.int64)
        for _, _, dictionaries, codes in _read(batches):
            nearest, _ = assign(dictionaries, codes, book, parts)
            more, added = sums(dictionaries, codes, nearest, entries)
            n, total = n + more, total + added
        entry, place = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(n[entry, place]),
             pa.array(total[entry, place])], ["entry", "place", "n", "total"])

    found = blocks.mapInArrow(add, SUMS).groupBy("entry", "place").agg(F.sum("n"), F.sum("total")).collect()
    after = book.copy()
    for entry, place, n, total in found:
        after[entry, place] = total // n
    return after


def _blocks(kept: DataFrame, width: int) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                dictionaries, codes = encode(whole(matrix(rows.column(1), width)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([rows.column(2).to_pylist()], pa.list_(pa.int32())),
                     pa.array([[values.tolist() for values in dictionaries]], pa.list_(pa.list_(pa.int32()))),
                     pa.array([codes.tobytes()], pa.binary())], ["ids", "labels", "dictionaries", "codes"])

    return kept.select("vec_id", "embedding", "label").mapInArrow(write, BLOCKS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[np.ndarray], np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids, labels = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            dictionaries = [np.array(v, np.int64) for v in batch.column(2)[row].as_py()]
            codes = np.frombuffer(batch.column(3)[row].as_py(), np.uint16).reshape(len(dictionaries), len(ids))
            yield ids, labels, dictionaries, codes


def _coded(blocks: DataFrame, book: np.ndarray, parts: int) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, dictionaries, codes in _read(batches):
            nearest, error = assign(dictionaries, codes, book, parts)
            text = nearest.astype(np.uint8).T.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()),
                 pa.array([text[2 * parts * i:2 * parts * (i + 1)] for i in range(len(ids))]), pa.array(error)],
                ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(code, CODED)
