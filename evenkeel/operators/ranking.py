"""Positions in one order over a whole table, without a one-task window.

Rows are numbered inside digest buckets; bucket offsets come from counted
buckets. Only the counts meet in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.order import digest_bucket, seeded_order
from evenkeel.sources.staging import staged

# 16**4 buckets: the offset table has 65,536 rows at most.
RANK_DIGITS = 4
ORDER, BUCKET = "_order", "_bucket"
BEFORE = (Window.unboundedPreceding, -1)


def bucketed(df: DataFrame, key: str, seed: int = 0, digits: int = RANK_DIGITS) -> DataFrame:
    """Add the seeded order and its bucket."""
    return (df.withColumn(ORDER, seeded_order(F.col(key), seed))
            .withColumn(BUCKET, digest_bucket(F.col(ORDER), digits)))


def seeded_positions(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Add `position` (from 1) in seeded order; `_bucket` and `_order` stay.

    `key` must name one row. Rows are shuffled once, by bucket.
    """
    marked = bucketed(df, key, seed)
    counts = marked.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy(BUCKET).rowsBetween(*BEFORE))
    offsets = counts.select(BUCKET, F.coalesce(before, F.lit(0)).alias("_before"))
    in_bucket = Window.partitionBy(BUCKET).orderBy(ORDER, key)
    # 65,536 offsets at most: broadcast.
    return (marked.join(F.broadcast(offsets), BUCKET)
            .withColumn("position", F.col("_before") + F.row_number().over(in_bucket))
            .drop("_before"))


def queue_positions(df: DataFrame, arrival: str, key: str, seed: int = 0, group: str | None = None) -> DataFrame:
    """Add `position` (from 1) in a queue: by arrival, then seeded; with `group`, in a queue of each.

    What arrives at one instant is spread over digest buckets. Sums run over
    the instants of a minute, and over the minutes of a whole queue, which is
    the only step in one task: a row per minute. `group` is not null. Runs a job
    when called.
    """
    own = [] if group is None else [group]
    minute = F.date_trunc("minute", F.col(arrival))
    # Staged, so that what leads to the queue is worked out once.
    marked = staged(bucketed(df, key, seed, digits=3).withColumn("_minute", minute), "queue")
    counts = marked.groupBy(*own, "_minute", arrival, BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    minutes = counts.groupBy(*own, "_minute").agg(F.sum("rows").alias("rows"))
    before_minute = F.sum("rows").over(Window.partitionBy(*own).orderBy("_minute").rowsBetween(*BEFORE))
    in_minute = Window.partitionBy(*own, "_minute").orderBy(arrival, BUCKET)
    offsets = (counts
               .withColumn("_in_minute", F.coalesce(F.sum("rows").over(in_minute.rowsBetween(*BEFORE)),
                                                    F.lit(0)))
               .join(minutes.select(*own, "_minute", F.coalesce(before_minute, F.lit(0)).alias("_earlier")),
                     [*own, "_minute"])
               .select(*own, "_minute", arrival, BUCKET, (F.col("_in_minute") + F.col("_earlier")).alias("_before")))
    place = [*own, "_minute", arrival, BUCKET]
    in_bucket = Window.partitionBy(*place).orderBy(ORDER, key)
    return (marked.join(offsets, place)
            .withColumn("position", F.col("_before") + F.row_number().over(in_bucket))
            .drop("_before", "_minute", ORDER, BUCKET))


def first_positions(df: DataFrame, order: str, key: str, group: str, wanted: DataFrame) -> DataFrame:
    """The first rows of each group by digest `order`, with `position` (from 1).

    `wanted` has (`group`, `wanted`), how many to find. Rows are counted by
    digest bucket, 4,096 of a group at most; only buckets that start within
    the wanted number are read on, so what is shuffled grows with the rows
    that are found. `group` is not null, `key` names one row of a group.
    """
    marked = df.withColumn(BUCKET, digest_bucket(F.col(order), 3))
    counts = marked.groupBy(group, BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(group).orderBy(BUCKET).rowsBetween(*BEFORE))
    offsets = (counts.select(group, BUCKET, F.coalesce(before, F.lit(0)).alias("_before")).join(wanted, group)
               .filter(F.col("_before") < F.col("wanted")))
    in_bucket = Window.partitionBy(group, BUCKET).orderBy(order, key)
    placed = marked.join(offsets, [group, BUCKET]).withColumn(
        "position", F.col("_before") + F.row_number().over(in_bucket))
    return placed.filter(F.col("position") <= F.col("wanted")).drop("_before", "wanted", BUCKET)
