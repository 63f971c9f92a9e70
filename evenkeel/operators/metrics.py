"""Crawl metrics: counters per tick, rates, totals and gauges.

One point per tag and tick, with `step` counted from the first tick of a run.
Ticks are event-time windows aligned to the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions import patterns as P
from evenkeel.sources.staging import staged

TICK_SECONDS = 60
COUNTERS = ("requests", "responses", "bytes", "saved", "first_failures", "retries", "failed_permanently")
TICKS = "run string, tick bigint, status int, " + ", ".join(f"{c} bigint" for c in COUNTERS)
BYTES_PER_MB = 1e6


def tick_counts(log: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Counters per (run, tick, status)."""
    failed = F.col("kind") == "failed"
    retry = F.col("attempt") == 2
    counts = (log.groupBy("run", F.window("ts", f"{seconds} seconds").alias("w"), "status")
              .agg(F.count(F.lit(1)).alias("requests"),
                   F.count("status").alias("responses"),
                   F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                   F.count_if(F.col("kind") == "saved").alias("saved"),
                   F.count_if(failed & ~retry).alias("first_failures"),
                   F.count_if(retry).alias("retries"),
                   F.count_if(failed & retry).alias("failed_permanently")))
    return counts.select("run", F.unix_seconds("w.start").alias("tick"), "status", "requests",
                         "responses", "bytes", "saved", "first_failures", "retries",
                         "failed_permanently")


def add_ticks(parts: DataFrame) -> DataFrame:
    """Counters of parts of a log as those of the whole."""
    return parts.groupBy("run", "tick", "status").agg(*[F.sum(c).alias(c) for c in COUNTERS])


def counter_points(ticks: DataFrame) -> DataFrame:
    """(run, tick, counter, value): what each counter grew by in a tick."""
    def point(counter: Column, value: str) -> Column:
        return F.struct(counter.alias("counter"), F.col(value).alias("value"))

    per_status = F.concat(F.lit(P.COUNTER_STATUS_PREFIX), F.col("status").cast("string"))
    points = F.array(
        point(F.lit(P.COUNTER_SAVED), "saved"),
        point(F.lit(P.COUNTER_RESPONSES), "responses"),
        point(F.lit(P.COUNTER_REQUESTS), "requests"),
        point(F.lit(P.COUNTER_FAILED), "failed_permanently"),
        point(F.lit(P.COUNTER_BYTES), "bytes"),
        point(per_status, "responses"))
    return (ticks.select("run", "tick", F.inline(points)).filter(F.col("counter").isNotNull())
            .groupBy("run", "tick", "counter").agg(F.sum("value").alias("value")))


def fill_gaps(points: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Zero points for silent ticks, from a counter's first tick to the run's last.

    The points are staged, so that the log is read once.
    """
    points = staged(points, "points")
    ends = points.groupBy("run").agg(F.max("tick").alias("last"))
    starts = points.groupBy("run", "counter").agg(F.min("tick").alias("first"))
    every = starts.join(ends, "run").select(
        "run", "counter",
        F.explode(F.sequence("first", "last", F.lit(seconds).cast("long"))).alias("tick"))
    return (every.join(points, ["run", "counter", "tick"], "left")
            .select("run", "tick", "counter", F.coalesce("value", F.lit(0)).alias("value")))


def rate_points(points: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Metric points (run, tick, step, tag, value) of counter growth."""
    counter, value = F.col("counter"), F.col("value").cast("double")
    status = F.substring(counter, len(P.COUNTER_STATUS_PREFIX) + 1, 16)
    tag = (F.when(counter == P.COUNTER_SAVED, P.TAG_SAVED_RATE)
           .when(counter == P.COUNTER_RESPONSES, P.TAG_RESPONSE_RATE)
           .when(counter == P.COUNTER_REQUESTS, P.TAG_REQUEST_RATE)
           .when(counter == P.COUNTER_FAILED, P.TAG_FAILED_RATE)
           .when(counter == P.COUNTER_BYTES, P.TAG_MB_RATE)
           .when(counter.startswith(P.COUNTER_STATUS_PREFIX),
                 F.concat(F.lit(P.TAG_STATUS_PREFIX), status, F.lit(P.TAG_STATUS_SUFFIX))))
    scaled = F.when(counter == P.COUNTER_BYTES, value / BYTES_PER_MB).otherwise(value)
    return _with_step(points, seconds).select("run", "tick", "step", tag.alias("tag"),
                                              scaled.alias("value")).filter(F.col("tag").isNotNull())


def crawl_rates(log: DataFrame, seconds: int = TICK_SECONDS, fill: bool = False) -> DataFrame:
    """Rates per tick and tag; a new status code gets its own tag."""
    points = counter_points(tick_counts(log, seconds))
    return rate_points(fill_gaps(points, seconds) if fill else points, seconds)


def counter_snapshots(log: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Counter totals at every tick, as a sampler of the counters sees them.

    A window holds one counter of one run: a row per tick, whatever the traffic.
    """
    points = fill_gaps(counter_points(tick_counts(log, seconds)), seconds)
    total = F.sum("value").over(Window.partitionBy("run", "counter").orderBy("tick")
                                .rowsBetween(Window.unboundedPreceding, 0))
    return points.select("run", "tick", "counter", total.alias("value"))


def counter_deltas(snapshots: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Rates from sampled totals: the difference to the tick before, at first to zero."""
    before = F.lag("value", 1, 0).over(Window.partitionBy("run", "counter").orderBy("tick"))
    return rate_points(snapshots.withColumn("value", F.col("value") - before), seconds)


def crawl_progress(log: DataFrame, sizes: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Totals and gauges per tick; `sizes` has (run, pending, backlog).

    Each permanent failure draws one link from the backlog while it lasts. The
    window holds a row per tick of a run.
    """
    per_tick = tick_counts(log, seconds).groupBy("run", "tick").agg(
        *[F.sum(c).alias(c) for c in ("saved", "failed_permanently", "first_failures", "retries")])
    so_far = Window.partitionBy("run").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    totals = per_tick.select("run", "tick", *[F.sum(c).over(so_far).alias(c) for c in (
        "saved", "failed_permanently", "first_failures", "retries")]).join(sizes, "run")
    drawn = F.least("failed_permanently", "backlog")

    def point(tag: str, value: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), value.cast("double").alias("value"))

    gauges = F.array(
        point(P.TAG_SAVED_TOTAL, F.col("saved")),
        point(P.TAG_FAILED_TOTAL, F.col("failed_permanently")),
        point(P.TAG_BACKLOG_TOTAL, drawn),
        point(P.TAG_REMAINING, F.col("pending") - F.col("saved")
              - (F.col("failed_permanently") - drawn)),
        point(P.TAG_RETRY_QUEUE, F.col("first_failures") - F.col("retries")))
    return _with_step(totals, seconds).select("run", "tick", "step", F.inline(gauges))


def _with_step(points: DataFrame, seconds: int) -> DataFrame:
    """Add `step` from the first tick of the run; the points are written, as they are read twice."""
    points = staged(points, "points")
    first = points.groupBy("run").agg(F.min("tick").alias("_first"))
    step = ((F.col("tick") - F.col("_first")) / seconds).cast("long") + 1
    return points.join(first, "run").withColumn("step", step).drop("_first")
