"""Streams give what the batch gives."""

from datetime import datetime, timedelta

import pytest

from evenkeel.operators import crawl, metrics
from evenkeel.sources import tables
from evenkeel.streaming import crawl as live

START = datetime(2024, 1, 1)


def attempts(spark, first, last):
    rows = [("r", START + timedelta(seconds=7 * i), f"u{i % 40}" if i < 40 else f"u{i - 40}",
             1 if i < 40 else 2, "failed" if i % 3 else "saved", 200 if i % 4 else None, i)
            for i in range(first, last)]
    return spark.createDataFrame(rows, tables.ATTEMPTS)


@pytest.fixture
def log(spark, tmp_path):
    path = f"{tmp_path}/log"
    attempts(spark, 0, 50).coalesce(1).write.mode("append").parquet(path)
    return path


def test_ticks_equal_the_batch(spark, log, tmp_path):
    def run():
        stream = live.stream_attempts(spark, log, files_per_trigger=1)
        live.write_ticks(stream, f"{tmp_path}/ticks", f"{tmp_path}/state", available_now=True).awaitTermination()
        return {tuple(r) for r in live.read_ticks(spark, f"{tmp_path}/ticks").collect()}

    def batch(first, last):
        return {tuple(r) for r in metrics.tick_counts(attempts(spark, first, last)).collect()}

    assert run() == batch(0, 50)  # the open tick as well
    attempts(spark, 70, 80).coalesce(1).write.mode("append").parquet(log)
    assert run() != batch(0, 80)
    attempts(spark, 50, 70).coalesce(1).write.mode("append").parquet(log)  # late and out of order
    assert run() == batch(0, 80)


def test_outcomes_follow_the_log(spark, log, tmp_path):
    def run():
        stream = live.stream_attempts(spark, log)
        live.write_outcomes(stream, f"{tmp_path}/out", f"{tmp_path}/state",
                            available_now=True).awaitTermination()
        return {tuple(r) for r in live.latest_outcomes(spark, f"{tmp_path}/out").select(
            "url", "attempts", "outcome").collect()}

    def batch(last):
        return {tuple(r) for r in crawl.crawl_outcome(attempts(spark, 0, last)).select(
            "url", "attempts", "outcome").collect()}

    assert run() == batch(50)
    attempts(spark, 50, 80).coalesce(1).write.mode("append").parquet(log)
    assert run() == batch(80)
    tables.append_failed_log(crawl.permanent_failures(live.latest_outcomes(spark, f"{tmp_path}/out")),
                             f"{tmp_path}/failed")
    failed = {r.url for r in tables.read_failed_log(spark, f"{tmp_path}/failed").collect()}
    assert failed == {u for u, _, outcome in batch(80) if outcome == "failed_permanently"} != set()


def test_training_stream(spark, tmp_path):
    df = spark.createDataFrame([("h", "l", "w", "r", True, ("user", "p"))], tables.TRAINING)
    tables.write_training(df, f"{tmp_path}/training")
    stream = tables.stream_training(spark, f"{tmp_path}/training").filter("train")
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state")
             .trigger(availableNow=True).start(f"{tmp_path}/out"))
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").first().input.content == "p"


def test_observed_progress(spark):
    observed, progress = live.observe_progress(attempts(spark, 0, 80))
    observed.write.format("noop").mode("overwrite").save()
    assert progress.get == {"saved": 27, "failed_permanently": 27}
