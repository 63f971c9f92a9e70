import random
from collections import Counter

from pyspark.sql import functions as F

from evenkeel.operators import balance
from evenkeel.plans import pipeline

SCHEMA = "link string, website string, response string"


def sites(spark, sizes):
    rows = [(f"{name}{i}", name, "r") for name, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_distribution(spark):
    df = sites(spark, {"a": 3, "b": 1}).unionByName(spark.createDataFrame([("x", None, "r")], SCHEMA))
    got = {r.website: (r.n, r.frequency) for r in balance.website_distribution(df).collect()}
    assert got == {"a": (3, 0.6), "b": (1, 0.2), None: (1, 0.2)}


def test_hold_out_ties_go_by_name(spark):
    df = sites(spark, {"d": 2, "c": 2, "b": 2, "a": 9})
    train, held = balance.compute_dataset_split(df, k=2)
    assert {r.website for r in held.collect()} == {"b", "c"}
    assert {r.website for r in train.collect()} == {"a", "d"}


def test_split_when_the_first_row_is_held_out(spark):
    df = sites(spark, {"rare": 1, "big": 5})
    train, held = balance.compute_dataset_split(df, k=1)
    assert (train.count(), held.count()) == (5, 1)


def test_rows_without_website_are_rejected(spark):
    rows = [("www.a.com/1", "t", "i", "d"), ("www.b", "t", "i", "d"), (None, "t", "i", "d")]
    recipes = spark.createDataFrame(rows, "link string, title string, ingredients string, directions string")
    prepared = pipeline.prepare_dataset(recipes)
    assert prepared.dataset.count() == 1
    assert {r.link for r in prepared.rejected.collect()} == {"www.b", None}


def test_balanced_dataset(spark):
    rng = random.Random(3)
    sizes = {f"w{i:02}": rng.randrange(5, 40) for i in range(22)} | {"hot": 500}
    keyed = sites(spark, sizes).withColumn("link_hash", F.sha2("link", 256)).select(
        "link", "website", "link_hash", "response")
    for limit in (1 << 26, 0):
        rows = pipeline.balance_dataset(keyed, k=16, broadcast_bytes=limit).collect()
        held = set(sorted(sizes, key=lambda w: (sizes[w], w))[:16])
        assert {r.website for r in rows if not r.train} == held
        least = {True: min(n for w, n in sizes.items() if w not in held), False: min(sizes.values())}
        counts = Counter((r.website, r.train) for r in rows)
        assert counts == {(w, w not in held): least[w not in held] for w in sizes}
        assert len({r.link for r in rows}) == len(rows)


def test_dedup_keeps_the_rarest_website(spark):
    rows = [("1", "big", "same"), ("2", "big", "other"), ("3", "big", "x"), ("4", "rare", "same"),
            ("5", None, "same"), ("6", "big", None), ("7", "rare", None), ("0", "rare", "same")]
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (1 << 26, 0):
        got = {tuple(r) for r in balance.deduplicate(df, broadcast_bytes=limit).collect()}
        assert got == {("0", "rare", "same"), ("2", "big", "other"), ("3", "big", "x"), ("7", "rare", None)}


def test_dedup_of_a_dominant_response(spark):
    rows = [(f"l{i}", f"w{i % 5}", "copy" if i % 3 else f"r{i}") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = balance.deduplicate(df)
    assert got.count() == 301
    assert got.filter("response = 'copy'").first().website == "w0"


def test_dedup_combines_before_the_shuffle(spark):
    marked = balance._marked(sites(spark, {"a": 3}), "link", "response", "website", 1 << 26)
    plan = balance.repeated_responses(marked, "link", "website")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1 and plan.count("partial_count") >= 1


def test_dedup_of_rows_repeated_whole(spark):
    rows = [("1", "a", "same"), ("1", "a", "same"), ("1", "a", "same"), ("2", "b", "same"), ("2", "b", None),
            ("2", "b", None), (None, "a", "x"), (None, "a", "x"), ("3", "b", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (1 << 26, 0):
        got = sorted((tuple(r) for r in balance.deduplicate(df, broadcast_bytes=limit).collect()), key=str)
        assert got == sorted([("2", "b", "same"), ("2", "b", None), (None, "a", "x"), ("3", "b", "")], key=str)
    assert balance.deduplicate(df.filter("false")).count() == 0


def test_split_report(spark):
    before = sites(spark, {"a": 10, "b": 4})
    after = spark.createDataFrame([(True,)] * 4 + [(False,)] * 2, "train boolean")
    assert balance.split_report(before, after).first().asDict() == {
        "train_rows": 4, "eval_rows": 2, "eval_to_train": 0.5, "rows_before": 14, "rows_after": 6,
        "rows_lost": 8}


def test_salts_follow_the_count(spark, monkeypatch):
    monkeypatch.setattr(balance, "ROWS_PER_SALT", 10)
    rows = [(f"l{i}", "hot" if i < 500 else f"s{i % 30}") for i in range(800)] + [("x", None)]
    df = spark.createDataFrame(rows, "link string, website string")
    salted = balance.with_website_counts(df, "link", broadcast_bytes=0)
    assert sorted(map(tuple, salted.select("link", "n").collect())) == sorted(
        map(tuple, balance.with_website_counts(df, "link").select("link", "n").collect()))
