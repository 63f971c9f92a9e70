"""Best-fit packing of token sequences by hierarchical residual packing.

Pieces are packed best-fit, longest first, inside each partition. Nearly full
bins are final; the others are merged up a tree, as items of the next round,
in fewer and fewer groups. A task holds one block of lengths at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm import tokens
from evenkeel.llm.spans import lean
from evenkeel.sources.staging import staged

CAPACITY = 1024
END_ID = 2
# Items that one task packs at a time.
BLOCK = 1 << 15
# A bin with less room than this is final.
SLACK = 8
# Bins that one group of a merge round holds, and rounds at most.
FAN = 8
# Texts that are encoded together.
TEXTS, TEXT_CHARS = 2_048, 4_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


@dataclass(frozen=True)
class Tokenizer:
    vocabulary: str
    ranks: str
    pattern: str


def public_tokenizer() -> Tokenizer:
    """The public byte-level vocabulary; each worker needs its files at the same path."""
    import public_tokenizers

    return Tokenizer(public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def pieces(docs: DataFrame, tokenizer: Tokenizer, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids): the token ids of each document, cut to the capacity.

    A document is its ids and then `end_id`; a null text is empty. Only longer
    ones are cut, from the end: the first piece may be shorter. `ids` holds
    packed little-endian unsigned 32-bit numbers. Every row is a document,
    whether its doc_id is null or repeats; other columns are not used.
    """
    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer.vocabulary, tokenizer.ranks, tokenizer.pattern).encode
        try:
            for batch in batches:
                for doc_ids, texts in _portions(batch):
                    yield _cut(doc_ids, encode(texts), capacity, end_id)
        finally:
            tokens.forget()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Consecutive rows with a bound on texts and characters."""
    ids, texts, chars = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
        value = text.as_py()
        ids.append(doc_id.as_py())
        texts.append(value)
        chars += len(value)
        if len(texts) == TEXTS or chars >= TEXT_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if texts:
        yield ids, texts


def _cut(doc_ids: list, encoded: list[bytes], capacity: int, end_id: int) -> pa.RecordBatch:
    end = tokens.pack([end_id])
    rows: list[tuple] = []
    for doc_id, ids in zip(doc_ids, encoded, strict=True):
        ids += end
        count = len(ids) // 4
        edges = list(range(count % capacity or capacity, count + 1, capacity)) if count > capacity else [count]
        start = 0
        for number, stop in enumerate(edges):
            rows.append((doc_id, number, start, stop - start, ids[4 * start:4 * stop]))
            start = stop
    columns = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["doc_id", "piece", "start", "length", "ids"])


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the fill of each bin: longest first, into the tightest room."""
    place, offset, fill = [0] * len(lengths), [0] * len(lengths), []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            found = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            found, room = len(fill), capacity
            fill.append(0)
        place[item], offset[item] = found, fill[found]
        fill[found] += size
        if room > size:
            rooms[room - size].append(found)
            open_rooms |= 1 << (room - size)
    return place, offset, fill


def _packed(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """`items` with bin, offset and the bin's fill; the partitions are packed on their own."""
    added = [T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
             T.StructField("fill", T.LongType())]
    schema = T.StructType(items.schema.fields + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The same number when the task runs again: partition, then bins in order.
        base = (level << 56) + (TaskContext.get().partitionId() << 28)
        for table in _blocks(batches):
            place, offset, fill = best_fit(table.column("length").to_pylist(), capacity)
            fill_of = np.array(fill, np.int64)
            bins = np.array(place, np.int64)
            out = table
            for name, values in (("bin", base + bins), ("offset", np.array(offset, np.int64)),
                                 ("fill", fill_of[bins])):
                out = out.append_column(name, pa.array(values))
            base += len(fill)
            yield from out.to_batches()

    return items.mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BLOCK - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == BLOCK:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`items` (each with a length up to the capacity) with sequence_id and offset.

    Runs jobs when called. The items are written once with their bin; what
    moves up the tree is one narrow row per bin that is not nearly full.
    Nothing is left out: a bin that no round can fill is a sequence of its own.
    No items give no rows.
    """
    names = items.columns
    stored = staged(items, "pieces")
    groups = max(1, -(-stored.count() // BLOCK))
    spread = stored.repartition(groups, F.xxhash64("doc_id", "piece", "length"))
    placed = staged(_packed(spread, capacity, 1), "packed")
    loose = placed.filter((F.col("offset") == 0) & (F.col("fill") < capacity - SLACK)).select(
        F.col("bin").alias("item"), F.col("fill").alias("length"))
    moves = None
    level, waiting = 2, loose.count()
    while waiting > 1:
        # Bins that do not merge stay spread: a group gets FAN blocks at most, and the tree ends there.
        before, least = groups, -(-waiting // (FAN * BLOCK))
        groups = max(min(-(-groups // FAN), -(-waiting // BLOCK)), least)
        merged = staged(_packed(loose.repartition(groups, F.xxhash64("item")), capacity, level), "merged")
        step = merged.select("item", F.col("bin").alias("to"), F.col("offset").alias("shift"))
        if moves is None:
            moves = step
        else:
            step = step.withColumnsRenamed({"item": "_item", "to": "_to", "shift": "_shift"})
            both = moves.join(step, F.col("to") == F.col("_item"), "left")
            moves = staged(both.select("item", F.coalesce("_to", "to").alias("to"),
                                       (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift")), "moves")
        loose = merged.filter((F.col("offset") == 0) & (F.col("fill") < capacity - SLACK)).select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))
        level += 1
        waiting = loose.count()
        if groups == 1 or groups >= before:
            break
    if moves is None:
        return placed.select(*names, F.col("bin").alias("sequence_id"), "offset")
    done = placed.join(moves, F.col("bin") == F.col("item"), "left")
    return done.select(*names, F.coalesce("to", "bin").alias("sequence_id"),
                       (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): each sequence's packed ids, and the documents in it, in order.

    `placed` has the ids of `pieces`. A sequence is bounded by the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
