"""Crawl metrics and outcomes as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from evenkeel.operators import crawl, metrics
from evenkeel.sources import batches
from evenkeel.sources.tables import ATTEMPTS


def stream_attempts(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Attempt log as a stream of Parquet files."""
    reader = spark.readStream.schema(ATTEMPTS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_ticks(attempts: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                seconds: int = metrics.TICK_SECONDS):
    """Start the count of a live attempt log: each micro-batch writes what it adds to its ticks.

    The counts are sums, so nothing is kept in a state and nothing is too late:
    a record counts in its tick whenever it comes. A micro-batch that is run
    again overwrites its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(metrics.tick_counts(batch, seconds), path, batch_id)

    return _start(attempts, write, checkpoint, available_now)


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Counters per (run, tick, status) of all that was written, the last and open ticks included."""
    return metrics.add_ticks(batches.read_batches(spark, path, metrics.TICKS))


def compact_ticks(spark: SparkSession, path: str, fan: int = batches.FAN) -> list[str]:
    """Add up the counters of old batches; readers see the same ticks before and after."""
    return batches.compact(spark, path, metrics.TICKS, metrics.add_ticks, fan)


def write_outcomes(attempts: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Start the write of what each micro-batch tells of its URLs.

    Minima and maxima alone, merged when they are read: no state grows with the
    crawl. A micro-batch owns its folder and overwrites it when it is run
    again, so a restart neither loses nor repeats anything.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(crawl.outcome_states(batch), path, batch_id)

    return _start(attempts, write, checkpoint, available_now)


def latest_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcome per URL of all that was written; `crawl.permanent_failures` of it is the failed log."""
    return crawl.outcomes_of(crawl.merge_states(batches.read_batches(spark, path, crawl.STATES)))


def compact_outcomes(spark: SparkSession, path: str, fan: int = batches.FAN) -> list[str]:
    """Merge what old batches tell of each URL."""
    return batches.compact(spark, path, crawl.STATES, crawl.merge_states, fan)


def _start(attempts: DataFrame, write, checkpoint: str, available_now: bool):
    writer = attempts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


class ProgressListener(StreamingQueryListener):
    """Counts the saved pages of streams that observe them, and keeps a point at each `every`-th of them.

    A point is (saved, failed_permanently, batch). Register it with
    `spark.streams.addListener`; the streams read `observe_progress`. A batch that
    is run again is counted once.
    """

    def __init__(self, every: int = crawl.PROGRESS_EVERY, name: str = "crawl_progress"):
        self.every, self.name = every, name
        self.saved, self.failed, self.points = 0, 0, []
        self._seen: dict = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None or self._seen.get(progress.id, -1) >= progress.batchId:
            return
        self._seen[progress.id] = progress.batchId
        before, self.saved, self.failed = self.saved, self.saved + row["saved"], self.failed + row["failed_permanently"]
        for mark in range(before // self.every + 1, self.saved // self.every + 1):
            self.points.append((mark * self.every, self.failed, progress.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observe_stream(attempts: DataFrame, name: str = "crawl_progress") -> DataFrame:
    """A stream whose batches tell a `ProgressListener` what they saved."""
    return attempts.observe(name, *_progress())


def _progress() -> list:
    return [F.count_if(F.col("kind") == "saved").alias("saved"),
            F.count_if((F.col("kind") == "failed") & (F.col("attempt") == 2)).alias("failed_permanently")]


def observe_progress(attempts: DataFrame, name: str = "crawl_progress") -> tuple[DataFrame, Observation]:
    """Attach saved and failed counts to a job; read them from the observation."""
    observation = Observation(name)
    return attempts.observe(observation, *_progress()), observation
