"""The draw against brute force, under skew and with copies."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenkeel.operators import sampling


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def row_digest(link, website):
    return md5(f'{{"link":"{link}","website":"{website}"}}')


def brute(rows, quota, seed=0):
    groups = defaultdict(list)
    for link, website in rows:
        if website is not None:
            groups[website].append((md5(f"{seed}:{link}"), row_digest(link, website), link, website))
    return Counter((r[2], r[3]) for name, g in groups.items() for r in sorted(g)[:quota(name, len(g))])


def frame(spark, rows):
    return spark.createDataFrame(rows, "link string, website string")


def bag(df):
    return Counter(tuple(r) for r in df.select("link", "website").collect())


def skewed(seed=1):
    """One website with a third of the rows, one link with a third of them again."""
    rng = random.Random(seed)
    rows = [(f"l{rng.randrange(40)}", f"w{rng.randrange(12)}") for _ in range(800)]
    rows += [(f"h{i}", "hot") for i in range(300)] + [("copy", "hot")] * 300
    return rows + [("x", None)] * 50


@pytest.mark.parametrize("limit", [sampling.BROADCAST_BYTES, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("n", [0, 1, 40])
def test_exact_draw(spark, n, limit):
    rows = skewed()
    got = sampling.sample_by_website(frame(spark, rows), n, broadcast_bytes=limit)
    assert bag(got) == brute(rows, lambda _, size: n)


@pytest.mark.parametrize("limit", [sampling.BROADCAST_BYTES, 0], ids=["broadcast", "shuffled"])
def test_quota_that_ends_among_copies(spark, limit):
    rows = [("copy", "a")] * 500 + [(f"l{i}", "a") for i in range(20)] + [("z", "b")] * 9
    df = frame(spark, rows)
    histogram = sampling.group_histogram(df, "website", "link", broadcast_bytes=limit)
    for n in (3, 250, 519, 520, 10_000):
        got = sampling.draw(df, histogram, F.lit(n).cast("long"))
        assert bag(got) == brute(rows, lambda _, size: n), n


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from(["u", "v", None])), min_size=1,
                max_size=60), st.integers(0, 20), st.integers(0, 3), st.booleans())
def test_any_rows_any_quota(spark, rows, n, seed, small):
    df = frame(spark, rows).filter("website is not null")
    histogram = sampling.group_histogram(df, "website", "link", seed,
                                         sampling.BROADCAST_BYTES if small else 0)
    got = sampling.draw(df, histogram, F.lit(n).cast("long"))
    assert bag(got) == brute(rows, lambda _, size: n, seed)


def test_default_size_is_the_smallest_website(spark):
    rows = [("a", "u"), ("b", "u")] + [(f"l{i}", "v") for i in range(5)]
    assert Counter(r.website for r in sampling.sample_by_website(frame(spark, rows)).collect()) == {
        "u": 2, "v": 2}


def test_too_large_a_sample_is_an_error(spark):
    with pytest.raises(ValueError, match="cannot draw 3"):
        sampling.sample_by_website(frame(spark, [("a", "u"), ("b", "u")]), 3)


def test_empty_input(spark):
    assert sampling.sample_by_website(frame(spark, [])).count() == 0
    assert sampling.sample_by_website(frame(spark, []), 5).count() == 0


def test_sample_does_not_depend_on_partitioning(spark):
    df = frame(spark, skewed())
    first = bag(sampling.sample_by_website(df, 5))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert bag(sampling.sample_by_website(df.repartition(5), 5)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_seed_changes_the_sample(spark):
    df = frame(spark, skewed())
    assert bag(sampling.sample_by_website(df, 5, seed=1)) != bag(sampling.sample_by_website(df, 5))


def test_repeat_rows_in_portions(spark, monkeypatch):
    monkeypatch.setattr(sampling, "REPEAT_PORTION", 10)
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 57)], "k string, n int")
    got = sampling.repeat_rows(df, F.col("n")).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {"a": 1, "b": 10, "c": 11, "d": 57}


def test_wide_rows_are_not_shuffled(spark):
    rows = [(f"l{i}", f"w{i % 3}") for i in range(100)]
    df = frame(spark, rows).withColumn("body", F.repeat("link", 10))
    plan = sampling.sample_by_website(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_long_names_get_buckets_of_their_own(spark):
    name = "n" * 170
    df = spark.range(200_000).select(F.lit(name).alias("website"), F.col("id").cast("string").alias("link"))
    few = spark.range(3_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("website"),
                                    F.col("id").cast("string").alias("link"))
    histogram = sampling.group_histogram(df.unionByName(few), "website", "link")
    assert histogram.buckets.filter(F.col("website") == name).count() == 256


def test_repeated_rows_are_spread(spark):
    rows = spark.range(1_000).select("id", F.lit(10).alias("times"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sampling.repeat_rows(rows, F.col("times")).select(F.spark_partition_id().alias("p"))
        assert parts.count() == 10_000 and parts.distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
