"""The retry queue as a keyed state: a URL's first failure is held until its retry is due.

The URLs of a hash bucket share a state and its timers, so that a batch pays for
each bucket it meets and not for each URL. Of a (run, url), maxima and minima
alone are kept: records that come late, out of order or twice lead to the same
state; what is emitted is emitted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from evenkeel.sources import batches

# Fixed, as a checkpoint's states are found by bucket.
BUCKETS = 16_384
# A place per (run, url). Moments are microseconds since 1970, whatever time zones driver and workers have;
# `due` is the processing time, in milliseconds, at which a retry that waits is due.
STATE = "run array<string>, url array<string>, marks array<int>, first_failure array<bigint>, due array<bigint>"
EVENTS = "run string, url string, event string, first_failure bigint"
DUE, FAILED = "retry_due", "failed_permanently"
# What is known of a URL, as bits; the last two are what was emitted.
SAVED, ONCE, TWICE, RETRIED, DUE_SENT, FAILURE_SENT = (1 << n for n in range(6))
# A moment that is not known; later than any.
NEVER = 2 ** 63 - 1
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {"spark.sql.streaming.stateStore.providerClass": PROVIDER}
# Timers of processing time ask for one more batch without end, so a run that is to end takes data batches alone.
BOUNDED = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


class RetryWatch(StatefulProcessor):
    """Emits `retry_due` when a first failure has waited `delay_ms`, and `failed_permanently` at the second."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tries = handle.getValueState("tries", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, met = self._known(), set()
        for part in rows:
            for run, url, marks, at in zip(*(part[c].tolist() for c in ("run", "url", "marks", "at")), strict=True):
                link = _text(run), _text(url)
                before, first, due = known.get(link, (0, NEVER, NEVER))
                known[link] = before | marks, min(first, at), due
                met.add(link)
        now = timerValues.getCurrentProcessingTimeInMs() + self.delay_ms
        failed, waits = [], False
        for link in met:
            marks, first, due = known[link]
            if _waits(marks) and due == NEVER:
                due, waits = now, True
            if marks & TWICE and not marks & (SAVED | FAILURE_SENT):
                marks |= FAILURE_SENT
                failed.append((*link, FAILED, first))
            known[link] = marks, first, due
        self._keep(known)
        if waits:
            self.handle.registerTimer(now)
        yield from _events(failed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, known = expiredTimerInfo.getExpiryTimeInMs(), self._known()
        # A retry that came meanwhile needs no reminder.
        due = [link for link, (marks, _, at) in known.items() if at <= now and _waits(marks)]
        for link in due:
            marks, first, at = known[link]
            known[link] = marks | DUE_SENT, first, at
        if due:
            self._keep(known)
        yield from _events([(*link, DUE, known[link][1]) for link in due])

    def close(self) -> None:
        pass

    def _known(self) -> dict[tuple, tuple[int, int, int]]:
        found = self.tries.get()
        if found is None:
            return {}
        runs, urls, *told = found
        return dict(zip(zip(runs, urls, strict=True), zip(*told, strict=True), strict=True))

    def _keep(self, known: dict[tuple, tuple[int, int, int]]) -> None:
        runs, urls = zip(*known, strict=True)
        self.tries.update((list(runs), list(urls), *map(list, zip(*known.values(), strict=True))))


def _text(value) -> str | None:
    """pandas may hold a null as NaN."""
    return value if isinstance(value, str) else None


def _waits(marks: int) -> bool:
    return bool(marks & ONCE) and not marks & (SAVED | RETRIED | DUE_SENT)


def _events(found: list[tuple]) -> Iterator[pd.DataFrame]:
    if found:
        run, url, event, first = zip(*found, strict=True)
        first = pd.Series([None if at == NEVER else at for at in first], dtype="Int64")
        yield pd.DataFrame({"run": run, "url": url, "event": event, "first_failure": first})


def watch_retries(attempts: DataFrame, root: str, checkpoint: str, delay_ms: int, available_now: bool = False,
                  buckets: int = BUCKETS):
    """Start the watch of a live attempt log; events are written as batches under `root`, see `read_events`.

    A first failure is held in the state and emitted as due after `delay_ms`,
    unless its retry or a saved page came meanwhile; a second one is emitted
    once, for the failed log. A URL that is saved later fires nothing more. With
    `available_now` the run ends with its data, and timers fire in the batches
    that it has; otherwise they fire on their own. Attempts with null kind count
    as neither failed nor saved. A record that changes nothing (a first attempt
    that neither failed nor was saved) is not moved. `buckets` stays the same for
    a checkpoint.
    """
    spark = attempts.sparkSession
    settings = SETTINGS | (BOUNDED if available_now else {})
    before = {name: spark.conf.get(name, None) for name in settings}

    def write(batch: DataFrame, number: int) -> None:
        batches.write_batch(batch, root, number)

    told = attempts.select(F.pmod(F.xxhash64("run", "url"), F.lit(buckets)).alias("bucket"), "run", "url",
                           _marks().alias("marks"), _first_failure().alias("at")).filter("marks != 0")
    events = told.groupBy("bucket").transformWithStateInPandas(RetryWatch(delay_ms), EVENTS, "Update", "ProcessingTime")
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:  # a query keeps the settings that it was started with
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _marks() -> Column:
    """What a record tells of its URL."""
    failed, first, second = F.col("kind") == "failed", F.col("attempt") == 1, F.col("attempt") == 2
    told = {SAVED: F.col("kind") == "saved", ONCE: failed & first, TWICE: failed & second, RETRIED: second}
    return sum((F.when(met, bit).otherwise(0) for bit, met in told.items()), F.lit(0))


def _first_failure() -> Column:
    first = (F.col("kind") == "failed") & (F.col("attempt") == 1)
    return F.coalesce(F.when(first, F.unix_micros("ts")), F.lit(NEVER))


def read_events(spark, root: str) -> DataFrame:
    """(run, url, event, first_failure) of all batches, each event once."""
    events = batches.read_batches(spark, root, EVENTS)
    return events.withColumn("first_failure", F.timestamp_micros("first_failure"))
