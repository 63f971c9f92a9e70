"""Backlog draws, progress marks, the guard of keys, key filters."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.functions import links as L
from evenkeel.operators import crawl, keys, membership, pages
from evenkeel.sources import tables

START = datetime(2024, 1, 1)
FAILURES, BACKLOG = "run string, url string, failed_at timestamp", "run string, url string, crawl_order string"


def test_each_failure_draws_the_next_link(spark):
    rng = random.Random(3)
    failures = [("hot" if i % 3 else f"r{i % 7}", f"f{i}", START + timedelta(seconds=rng.randrange(300)))
                for i in range(400)] + [(None, "x", START)]
    backlog = [("hot" if i % 2 else f"r{i % 9}", f"b{i}", f"{rng.randrange(16**6):06x}{i:04x}") for i in range(300)]
    got = crawl.backlog_draws(spark.createDataFrame(failures, FAILURES), spark.createDataFrame(backlog, BACKLOG)).collect()
    import hashlib

    expected = {}
    for run in {r for r, *_ in failures if r}:
        queue = sorted((t, hashlib.md5(f"0:{u}".encode()).hexdigest(), u) for r, u, t in failures if r == run)
        links = [u for _, u in sorted((o, u) for r, u, o in backlog if r == run)]
        for k, (t, _, u) in enumerate(queue):
            expected[run, u] = (t, k + 1, links[k] if k < len(links) else None)
    assert {(r.run, r.url): (r.failed_at, r.position, r.replacement) for r in got} == expected
    assert any(v[2] is None for v in expected.values()) and any(v[2] for v in expected.values())


def test_draws_of_nothing(spark):
    none, some = spark.createDataFrame([], FAILURES), spark.createDataFrame([("r", "u", START)], FAILURES)
    assert crawl.backlog_draws(none, spark.createDataFrame([], BACKLOG)).count() == 0
    assert crawl.backlog_draws(some, spark.createDataFrame([], BACKLOG)).first().replacement is None


def test_only_the_drawn_part_of_the_backlog_is_read(spark):
    backlog = spark.range(5000).selectExpr("'r' run", "cast(id as string) url", "md5(cast(id as string)) crawl_order")
    from evenkeel.operators.ranking import first_positions

    wanted = spark.createDataFrame([("r", 7), ("other", 3)], "run string, wanted long")
    got = first_positions(backlog, "crawl_order", "url", "run", wanted).orderBy("position").collect()
    first = backlog.orderBy("crawl_order").limit(7).collect()
    assert [(r.url, r.position) for r in got] == [(r.url, i) for i, r in enumerate(first, 1)]


def test_progress_counts_dead_ends(spark):
    rows = [("r", START + timedelta(seconds=i), f"u{i}", 2 if i % 4 == 3 else 1, "failed" if i % 4 == 3 else "saved", 200, 1)
            for i in range(40)]
    log = spark.createDataFrame(rows + [(None, START, "x", 1, "saved", 200, 1)], tables.ATTEMPTS)
    sizes = spark.createDataFrame([("r", 40, 4)], "run string, pending long, backlog long")
    got = sorted(tuple(r) for r in crawl.progress_marks(log, sizes, every=10).select("saved", "url", "remaining").collect())
    # The 10th, 20th and 30th page, after 3, 6 and 9 failures: the backlog pays for 4 of them.
    assert got == [(10, "u12", 30), (20, "u25", 18), (30, "u38", 5)]


def test_a_bad_key_stops_plan_and_migration(spark):
    links = spark.createDataFrame([("www.a.com/x",), ("www.b.com/y",)], "link string").withColumn(
        "link_hash", L.link_hash("link"))
    none = spark.createDataFrame([], "file_name string")
    crawl.crawl_plan(links, none, spark.createDataFrame([], "url string"))
    bad = links.selectExpr("link", "case when link like '%b%' then reverse(link_hash) else link_hash end link_hash")
    for broken in (bad, links.selectExpr("link", "nullif(link_hash, link_hash) link_hash")):
        with pytest.raises(keys.KeyAuditError, match="not reproduced"):
            crawl.crawl_plan(broken, none, spark.createDataFrame([], "url string"))
        with pytest.raises(keys.KeyAuditError, match="not reproduced"):
            keys.rename_map(broken)
    assert crawl.crawl_plan(bad, none, spark.createDataFrame([], "url string"), check_keys=False).count() == 2


def test_a_plan_with_a_filter_is_the_same(spark):
    links = spark.range(3000).selectExpr("concat('www.s.com/', id) link").withColumn("link_hash", L.link_hash("link"))
    listing = links.filter("link like '%7'").select(L.page_file("link_hash").alias("file_name"))
    failed = links.filter("link like '%3'").select(L.fetch_url("link").alias("url"))
    known = crawl.known_keys(listing, failed)
    for limit in (None, 900):
        plans = [{tuple(r) for r in crawl.crawl_plan(links, listing, failed, limit, known=k).collect()} for k in (None, known)]
        assert plans[0] == plans[1] and len(plans[0]) == 3000


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 500)), st.sets(st.integers(0, 500)))
def test_filters_lose_nothing(spark, there, asked):
    members = spark.createDataFrame([(str(i),) for i in there] + [(None,)], "link_hash string")
    rows = spark.createDataFrame([(str(i), i) for i in asked] + [(None, -1)], "link_hash string, n int")
    known = membership.key_filter(members)
    assert {r.n for r in pages.scraped_only(rows, members, known).collect()} == there & asked
    assert {r.n for r in membership.strangers(rows, members, known).collect()} == (asked - there) | {-1}


def test_a_full_filter_only_passes_more(spark, monkeypatch):
    monkeypatch.setattr(membership, "MAX_BITS", 32_768)
    members = spark.range(200_000).selectExpr("cast(id as string) link_hash")
    known = membership.key_filter(members)
    assert known.bits == 32_768
    rows = spark.range(199_990, 200_020).selectExpr("cast(id as string) link_hash")
    assert pages.scraped_only(rows, members, known).count() == 10


def test_a_filter_turns_most_strangers_away(spark):
    known = membership.key_filter(spark.range(5000).selectExpr("cast(id as string) link_hash"))
    rows = spark.range(10_000, 30_000).selectExpr("cast(id as string) link_hash")
    assert membership.with_maybe(rows, known).filter("maybe").count() < 20_000 / 10
