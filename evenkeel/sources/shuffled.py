"""Training rows written in their shuffled order, for readers that take files one after the other.

Each file is a range of the seeded order and stands in a folder that is named
by the rows before it. So the names sort like the order, a row's position is
its folder's number and its place in the file, and a reader that has stopped
goes on at a position without reading what is before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.examples import SHARD_DIGITS, SHUFFLE_SEED, training_batches
from evenkeel.operators.ranking import BEFORE, BUCKET, ORDER, bucketed
from evenkeel.sources import files
from evenkeel.sources.staging import staged
from evenkeel.sources.tables import PAGE_GROUP_BYTES

ROWS_PER_FILE = 100_000
BATCHES_PER_FILE = 1_000
START = "start"


def write_shuffled(rows: DataFrame, key: str, path: str, seed: int = SHUFFLE_SEED,
                   rows_per_file: int = ROWS_PER_FILE, mode: str = "errorifexists") -> None:
    """Write `rows` in the seeded order of `key`, which names one row and is not null.

    Rows are counted by digest bucket first; a file takes as many buckets as
    `rows_per_file` allows, one at least. Then they are shuffled once, by file,
    and sorted once, inside it. The same rows and seed give the same files.
    """
    marked = bucketed(rows, key, seed)
    # 65,536 counts at most.
    counts = staged(marked.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows")), "order-counts")
    before = F.coalesce(F.sum("rows").over(Window.orderBy(BUCKET).rowsBetween(*BEFORE)), F.lit(0))
    placed = counts.withColumn("_before", before).withColumn("_file", F.floor(F.col("_before") / rows_per_file))
    first = F.min("_before").over(Window.partitionBy("_file")).cast("string")
    starts = staged(placed.select(BUCKET, F.lpad(first, SHARD_DIGITS, "0").alias(START)), "order-starts")
    parts = max(1, starts.select(START).distinct().count())
    (marked.join(F.broadcast(starts), BUCKET).repartition(parts, START).sortWithinPartitions(START, ORDER, key)
     .drop(BUCKET, ORDER).write.mode(mode).option("compression", "zstd").option("parquet.block.size", PAGE_GROUP_BYTES)
     .partitionBy(START).parquet(path))


def write_ordered_batches(examples: DataFrame, key: str, path: str, per_file: int = BATCHES_PER_FILE,
                          mode: str = "errorifexists", **options) -> None:
    """Write `training_batches` of `examples` where they are made: one shuffle, one sort, a file per shard.

    `read_shuffled` reads them; a file starts with a batch and holds whole ones.
    """
    batches = training_batches(examples, key, per_shard=per_file, before=START, **options)
    batches.write.mode(mode).option("compression", "zstd").partitionBy(START).parquet(path)


def read_shuffled(spark: SparkSession, path: str, schema: T.StructType, after: int = 0) -> DataFrame:
    """The rows with their `position` (from 1), from the one behind `after` on; earlier files are not read."""
    known = T.StructType([f for f in schema.fields if f.name != START] + [T.StructField(START, T.StringType())])
    rows = spark.read.schema(known).option("recursiveFileLookup", False).parquet(path)
    position = F.col(START).cast("bigint") + F.col("_metadata.row_index") + 1
    found = rows.select(*[f.name for f in known.fields], position.alias("position"))
    if after:
        starts = [name.split("=")[1] for name in files.names(spark, path) if name.startswith(f"{START}=")]
        held = max((s for s in starts if int(s) <= after), default="")
        found = found.filter((F.col(START) >= held) & (F.col("position") > after))
    return found.drop(START)
