from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import crawl
from evenkeel.operators.links import compute_link_hashes
from evenkeel.functions import links as L
from evenkeel.sources.tables import ATTEMPTS

START = datetime(2024, 1, 1)


def links(spark, n=40):
    return compute_link_hashes(spark.createDataFrame([(f"www.s{i}.com/",) for i in range(n)], "link string"))


def files(spark, df, numbers, stray=()):
    names = [r[0] for r in df.filter(F.col("link").isin([f"www.s{i}.com/" for i in numbers]))
             .select(L.page_file(F.col("link_hash"))).collect()]
    return spark.createDataFrame([(n,) for n in names + list(stray)], "file_name string")


def urls(spark, numbers):
    return spark.createDataFrame([(f"http://www.s{i}.com/",) for i in numbers], "url string")


def plan(spark, limit, seed=0):
    df = links(spark)
    listing = files(spark, df, range(5), ["README", "x.html"])
    return crawl.crawl_plan(df, listing, urls(spark, range(3, 9)), limit, seed)


@pytest.mark.parametrize("limit,pending", [(None, 31), (0, 0), (7, 0), (10, 3), (38, 31), (1000, 31)])
def test_budget(spark, limit, pending):
    counts = Counter(r.status for r in plan(spark, limit).collect())
    assert counts["cached"] == 5 and counts["known_failed"] == 4
    assert counts["pending"] == pending and counts["backlog"] == 31 - pending


def test_pending_comes_before_backlog(spark):
    rows = plan(spark, 20).collect()
    last = max(r.crawl_order for r in rows if r.status == "pending")
    assert all(r.crawl_order > last for r in rows if r.status == "backlog")
    assert {r.link for r in plan(spark, 20, seed=1).collect() if r.status == "pending"} != {
        r.link for r in rows if r.status == "pending"}


def test_report(spark):
    df = links(spark)
    listing = files(spark, df, range(5), ["README"])
    got = crawl.crawl_plan_report(crawl.crawl_plan(df, listing, urls(spark, []), 10), listing).first()
    assert got.asDict() == {"links": 40, "cached": 5, "known_failed": 0, "pending": 4, "backlog": 31,
                            "already_cached": 6}


def log(spark, rows):
    data = [("r", START + timedelta(seconds=s), url, attempt, kind, None, None)
            for s, url, attempt, kind in rows]
    return spark.createDataFrame(data, ATTEMPTS)


def test_outcomes(spark):
    rows = [(0, "retry", 1, "failed"), (1, "saved", 1, "failed"), (9, "saved", 2, "saved"),
            (2, "dead", 1, "failed"), (8, "dead", 2, "failed"), (8, "dead", 2, "failed"),
            (3, "fine", 1, "saved"), (4, "odd", 1, "responded"), (5, "odd2", 1, "failed"),
            (6, "odd2", 2, "responded"), (0, "retry", 1, "failed")]
    outcomes = crawl.crawl_outcome(log(spark, rows))
    assert {r.url: r.outcome for r in outcomes.collect()} == {
        "retry": "retry_pending", "saved": "saved", "dead": "failed_permanently", "fine": "saved",
        "odd": "responded_not_saved", "odd2": "responded_not_saved"}
    assert [r.url for r in crawl.permanent_failures(outcomes).collect()] == ["dead"]


def test_first_two_attempts(spark):
    rows = [(0, "a", "failed"), (1, "a", "failed"), (2, "a", "saved"), (0, "b", "saved"),
            (1, "b", "failed"), (5, "c", "failed"), (3, "c", "failed")]
    df = spark.createDataFrame(rows, "ts int, url string, kind string")
    got = crawl.first_two_attempts(df, ["url"], ["ts"])
    assert {tuple(r) for r in got.select("url", "ts", "attempt").collect()} == {
        ("a", 0, 1), ("a", 1, 2), ("b", 0, 1), ("c", 3, 1), ("c", 5, 2)}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_retry_batches_are_a_queue(spark):
    rows = [(60 * (i % 7), f"u{i}", 1, "failed") for i in range(100)]
    got = crawl.retry_batches(crawl.crawl_outcome(log(spark, rows)), size=30).collect()
    assert Counter(r.retry_batch for r in got) == {0: 30, 1: 30, 2: 30, 3: 10}
    for early in range(3):
        assert (max(r.first_failure for r in got if r.retry_batch == early)
                <= min(r.first_failure for r in got if r.retry_batch == early + 1))


def test_retry_batches_of_one_burst(spark):
    rows = [(5, f"u{i}", 1, "failed") for i in range(200)]
    got = crawl.retry_batches(crawl.crawl_outcome(log(spark, rows)), size=64).collect()
    assert Counter(r.retry_batch for r in got) == {0: 64, 1: 64, 2: 64, 3: 8}


def test_tries_keep_every_record(spark):
    rows = [(i, "u", "failed" if c == "f" else "saved") for i, c in enumerate("ffsfsfffs")]
    df = spark.createDataFrame(rows, "ts int, url string, kind string")
    got = sorted((r.ts, r["try"], r.attempt) for r in crawl.number_tries(df, ["url"], ["ts"]).collect())
    assert [(t, a) for _, t, a in got] == [(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (4, 1), (4, 2), (5, 1), (5, 2)]


def test_retry_order_inside_a_minute(spark):
    rows = [(i, f"u{i}", 1, "failed") for i in range(50)]
    got = crawl.retry_batches(crawl.crawl_outcome(log(spark, rows)), size=10).collect()
    assert {r.url: r.retry_batch for r in got} == {f"u{i}": i // 10 for i in range(50)}
