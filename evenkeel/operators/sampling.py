"""Exact samples: the rows that come first in seeded order, per group.

A window over whole groups would send a dominant website to one task, so the
draw works on digest buckets instead:

1. count rows per group, and from that choose buckets for each group: about as
   many as a bucket then has rows, so that steps 2 and 3 stay small;
2. count rows per (group, bucket) and find the bucket in which a group
   reaches its quota;
3. rank only the rows of that one bucket, copies collapsed, which gives the
   digest of the last row to keep;
4. keep the rows up to that digest: a filter behind a broadcast of one row per
   group or, when that table is too large, behind a join on (group, bucket),
   which spreads a dominant group over its buckets.

The digest covers the key and then the whole row. Copies of one row share
a digest; when the quota ends among them, the missing number is repeated from
one of them. The result is exact for any quota and any skew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.order import row_digest, seeded_order
from evenkeel.sources.staging import (
    BROADCAST_BYTES,
    key_bytes,
    staged,
    staged_with_facts,
)

# Hex digits by group size: a bucket of n rows in a group of about n**2.
DIGITS_BELOW = ((16, 0), (16**3, 1), (16**5, 2), (16**7, 3))
MAX_DIGITS = 4
# Groups that get buckets of their own choice, the largest ones first.
SIZED_GROUPS = 200_000
# Copies of one row are repeated in portions of this size.
REPEAT_PORTION = 65_536

ORDER, TIE, BUCKET = "_order", "_tie", "_bucket"


@dataclass(frozen=True)
class Histogram:
    """Rows per group (`counts`) and per (group, bucket) (`buckets`).

    `small`: one row per group may be broadcast.
    """

    group: str
    key: str
    seed: int
    counts: DataFrame
    buckets: DataFrame
    sizing: DataFrame
    other_digits: int
    smallest: int
    small: bool

    def bucketed(self, df: DataFrame) -> DataFrame:
        """Add the digest order and its bucket."""
        return _bucketed(df, self.group, self.key, self.seed, self.sizing, self.other_digits)


def group_histogram(df: DataFrame, group: str, key: str, seed: int = 0,
                    broadcast_bytes: int = BROADCAST_BYTES) -> Histogram:
    counts, sizes = staged_with_facts(
        df.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "counts",
        F.coalesce(F.min("n"), F.lit(0)).alias("smallest"), F.count(F.lit(1)).alias("groups"),
        key_bytes(group).alias("bytes"), F.floor(F.coalesce(F.avg("n"), F.lit(0))).alias("mean"))
    largest = counts
    if sizes["groups"] > SIZED_GROUPS:
        largest = counts.orderBy(F.desc("n"), group).limit(SIZED_GROUPS)
    # By a digest of the name: a long name counts like a short one, and the broadcast is bounded.
    sizing = largest.groupBy(F.xxhash64(group).alias("_name")).agg(F.max(_digits(F.col("n"))).alias("_digits"))
    other = next((d for below, d in DIGITS_BELOW if sizes["mean"] < below), MAX_DIGITS)
    marked = _bucketed(df.select(group, key), group, key, seed, sizing, other)
    small = sizes["bytes"] <= broadcast_bytes
    buckets = marked.groupBy(group, BUCKET).agg(F.count(F.lit(1)).alias("rows"))
    if not small:
        buckets = staged(buckets, "buckets")  # read twice by the draw
    return Histogram(group, key, seed, counts, buckets, sizing, other, sizes["smallest"], small)


def _digits(n: Column) -> Column:
    digits = F.lit(MAX_DIGITS)
    for below, value in reversed(DIGITS_BELOW):
        digits = F.when(n < below, value).otherwise(digits)
    return digits


def _bucketed(df: DataFrame, group: str, key: str, seed: int, sizing: DataFrame,
              other_digits: int) -> DataFrame:
    # SIZED_GROUPS rows of two numbers at most: broadcast.
    digits = F.coalesce("_digits", F.lit(other_digits))
    return (df.withColumn(ORDER, seeded_order(F.col(key), seed))
            .withColumn("_name", F.xxhash64(group)).join(F.broadcast(sizing), "_name", "left")
            .withColumn(BUCKET, F.substring(F.col(ORDER), F.lit(1), digits)).drop("_digits", "_name"))


def draw(df: DataFrame, histogram: Histogram, quota: Column,
         buckets: DataFrame | None = None) -> DataFrame:
    """Exactly `quota` rows of each group, the first ones in seeded order.

    `quota` is a column over the histogram's rows, or over `buckets`: the same
    rows with more columns. A group smaller than its quota is kept whole,
    a group with quota zero gives nothing.
    """
    columns, group = df.columns, histogram.group
    # Digest of the row in seeded order. The tie digest is written into the
    # conditions, where it is worked out for equal keys only.
    order = seeded_order(F.col(histogram.key), histogram.seed)
    tie = row_digest(columns)
    counted = histogram.buckets if buckets is None else buckets
    last = _last_buckets(counted.select(group, BUCKET, "rows", quota.alias("quota")), group)
    row = [group, BUCKET, ORDER, TIE]
    copies = F.count(F.lit(1)).alias("_copies")
    if histogram.small:
        # Nothing is shuffled: work out the row digest behind the join.
        keyed = df.withColumn(ORDER, order)
        ranked = (keyed.join(F.broadcast(last), group)
                  .filter(F.col(ORDER).startswith(F.col(BUCKET))).withColumn(TIE, tie)
                  .groupBy(*row, "_need").agg(copies))
    else:
        # Rows are shuffled: send digests instead of rows, copies as a count.
        keyed = histogram.bucketed(df)
        ranked = (keyed.withColumn(TIE, tie).groupBy(*row).agg(copies)
                  .join(last, [group, BUCKET]))
    whole = F.col("_take") == F.col("_copies")
    cuts, found = staged_with_facts(_cuts(ranked, group), "cuts", F.max(~whole).alias("split"))

    if histogram.small:
        near = keyed.join(F.broadcast(cuts.drop("_cut_bucket")), group)
    else:
        up_to_cut = (histogram.buckets.select(group, BUCKET).join(cuts, group)
                     .filter(F.col(BUCKET) <= F.col("_cut_bucket")).drop("_cut_bucket"))
        near = keyed.join(up_to_cut, [group, BUCKET])

    at_cut = (F.col(ORDER) == F.col("_cut_order")) & (tie == F.col("_cut_tie"))
    before_cut = (F.col(ORDER) < F.col("_cut_order")) | (
        (F.col(ORDER) == F.col("_cut_order")) & (tie < F.col("_cut_tie")))
    drawn = near.filter(before_cut | (whole & at_cut)).select(columns)
    if not found["split"]:
        return drawn
    # Some quota ends among copies of one row: one row per group, repeated.
    split = near.filter(~whole & at_cut).groupBy(*columns, "_take").agg(copies)
    return drawn.unionByName(repeat_rows(split, F.col("_take")).select(columns))


def sample_by_website(df: DataFrame, n: int | None = None, group: str = "website",
                      key: str = "link", seed: int = 0,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Exactly `n` rows without replacement from each website.

    `n` defaults to the size of the smallest website. Asking for more than
    that is an error, as nothing can be drawn twice.
    """
    known = df.filter(F.col(group).isNotNull())
    histogram = group_histogram(known, group, key, seed, broadcast_bytes)
    if n is None:
        n = histogram.smallest
    elif histogram.counts.isEmpty():
        return known
    elif histogram.smallest < n:
        raise ValueError(f"cannot draw {n} rows from a website with {histogram.smallest}")
    return draw(known, histogram, F.lit(n).cast("long"))


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row `times` times; portions are spread before they are unrolled."""
    counted = df.withColumn("_times", times.cast("long"))
    portions = counted.withColumn("_portion", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / REPEAT_PORTION))))
    left = F.least(F.lit(REPEAT_PORTION).cast("long"),
                   F.col("_times") - F.col("_portion") * REPEAT_PORTION)
    return (portions.repartition(F.xxhash64(*df.columns), "_portion")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
            .drop("_times", "_portion", "_copy"))


def _last_buckets(counted: DataFrame, group: str) -> DataFrame:
    """Bucket in which a group reaches its quota, and the rows needed from it."""
    in_group = Window.partitionBy(group).orderBy(BUCKET)
    # At most 16**MAX_DIGITS rows per group: bounded whatever the group's size.
    upto = F.sum("rows").over(in_group.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("rows").over(Window.partitionBy(group))
    reached = counted.withColumn("upto", upto).withColumn("total", total)
    quota = F.least("quota", "total")
    return (reached.filter((F.col("upto") >= quota) & (F.col("upto") - F.col("rows") < quota))
            .select(group, BUCKET, (quota - (F.col("upto") - F.col("rows"))).alias("_need")))


def _cuts(ranked: DataFrame, group: str) -> DataFrame:
    """Digest of the last row to keep per group; `take` of its `copies` belong."""
    in_bucket = Window.partitionBy(group, BUCKET).orderBy(ORDER, TIE)
    upto = F.sum("_copies").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0))
    return (ranked.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("_need")) & (F.col("upto") - F.col("_copies") < F.col("_need")))
            .select(group, F.col(BUCKET).alias("_cut_bucket"), F.col(ORDER).alias("_cut_order"),
                    F.col(TIE).alias("_cut_tie"),
                    (F.col("_need") - (F.col("upto") - F.col("_copies"))).alias("_take"), "_copies"))
