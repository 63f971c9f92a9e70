import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from evenkeel.operators import metrics
from evenkeel.sources.tables import ATTEMPTS

START = datetime(2024, 1, 1, 12)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        run, at = f"run{i % 2}", rng.randrange(0, 7200)
        kind = rng.choice(["saved", "failed", "failed", "responded"])
        status = {"saved": 200, "responded": 200, "failed": rng.choice([404, 503, None])}[kind]
        rows.append((run, START + timedelta(seconds=at), f"u{i}", 1, kind, status,
                     None if status is None else rng.randrange(10_000)))
        if kind == "failed" and i % 3:
            rows.append((run, START + timedelta(seconds=at + 300), f"u{i}", 2,
                         rng.choice(["saved", "failed"]), 200, 10))
    return spark.createDataFrame(rows, ATTEMPTS)


def points(df):
    return {(r.run, r.step, r.tag): r.value for r in df.collect()}


def test_deltas_of_snapshots_are_the_rates(log):
    assert points(metrics.counter_deltas(metrics.counter_snapshots(log))) == points(
        metrics.crawl_rates(log, fill=True))


def test_filling_adds_zeros_only(log):
    plain, filled = points(metrics.crawl_rates(log)), points(metrics.crawl_rates(log, fill=True))
    assert plain.items() <= filled.items()
    assert {v for k, v in filled.items() if k not in plain} == {0.0}
    steps = {s for run, s, tag in filled if run == "run0" and tag == "rate/requests_per_min"}
    assert steps == set(range(1, max(steps) + 1))


def test_rates_add_up(log):
    rows = log.collect()
    totals = defaultdict(float)
    for (_, _, tag), value in points(metrics.crawl_rates(log)).items():
        totals[tag] += value
    assert totals["rate/requests_per_min"] == len(rows)
    assert totals["rate/responses_per_min"] == sum(r.status is not None for r in rows)
    assert totals["http/404_per_min"] == sum(r.status == 404 for r in rows)
    assert totals["rate/mb_per_min"] == pytest.approx(sum(r.bytes or 0 for r in rows) / 1e6)


def test_gauges_against_a_replay(spark, log):
    pending, backlog = 200, 5
    sizes = spark.createDataFrame([(r, pending, backlog) for r in ("run0", "run1")],
                                  "run string, pending long, backlog long")
    got = points(metrics.crawl_progress(log, sizes))
    for run in ("run0", "run1"):
        rows = sorted((r for r in log.collect() if r.run == run), key=lambda r: r.ts)
        first = int((rows[0].ts - START).total_seconds()) // 60
        left, waiting, drawn, ends = pending, 0, 0, {}
        for r in rows:
            if r.attempt == 2:
                waiting -= 1
            if r.kind == "saved":
                left -= 1
            elif r.kind == "failed" and r.attempt == 1:
                waiting += 1
            elif r.kind == "failed":
                if drawn < backlog:
                    drawn += 1
                else:
                    left -= 1
            ends[int((r.ts - START).total_seconds()) // 60 - first + 1] = (left, waiting, drawn)
        for step, (a, b, c) in ends.items():
            assert got[run, step, "progress/remaining"] == a
            assert got[run, step, "progress/retry_queue"] == b
            assert got[run, step, "progress/backlog_drawn_total"] == c
