import pytest
from pyspark.sql import functions as F

from evenkeel.operators import keys


def pairs(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_audit(spark):
    stored = pairs(spark, [("a", "1"), ("a", "1"), ("b", "2"), ("c", "3")], ("link", "link_hash"))
    source = pairs(spark, [("a", "1"), ("b", "x")], ("link", "link_hash"))
    audit = keys.key_audit(stored, source)
    assert {r.link: r.verdict for r in audit.collect()} == {"a": "ok", "b": "mismatched", "c": "missing"}
    with pytest.raises(keys.KeyAuditError, match="'b'"):
        keys.require_clean_audit(audit)
    keys.require_clean_audit(audit.filter("verdict = 'ok'"))


def test_collisions(spark):
    mapping = pairs(spark, [("o1", "n1"), ("o1", "n1"), ("o1", "n2"), ("o2", "n2"), ("o3", "n3")],
                    ("old_name", "new_name"))
    assert {tuple(r) for r in keys.key_collisions(mapping).collect()} == {
        ("old_to_many", "o1", 2), ("many_to_new", "n2", 2)}


@pytest.fixture
def plan(spark):
    mapping = pairs(spark, [("o1.html", "n1.html"), ("o2.html", "n2.html"), ("o3.html", "n3.html")],
                    ("old_name", "new_name"))
    listing = pairs(spark, [("o1.html",), ("n2.html",), ("o2.html",), ("stray",), ("stray2",)],
                    ("file_name",))
    return keys.key_migration_plan(listing, mapping)


def test_migration_plan(plan):
    assert {tuple(r) for r in plan.collect()} == {
        ("o1.html", "n1.html", "rename"), ("n2.html", None, "already_migrated"),
        ("o2.html", "n2.html", "conflict"), ("stray", None, "unmatched"), ("stray2", None, "unmatched")}
    assert keys.key_migration_report(plan).first().asDict() == {
        "files": 5, "rename": 1, "already_migrated": 1, "conflict": 1, "unmatched": 2, "ambiguous": 0}
    assert [r.action for r in keys.key_migration_examples(plan).collect()] == ["conflict", "rename"]


def test_a_name_that_is_old_and_new_stays(spark):
    mapping = pairs(spark, [("a.html", "b.html"), ("b.html", "c.html")], ("old_name", "new_name"))
    listing = pairs(spark, [("b.html",)], ("file_name",))
    assert [tuple(r) for r in keys.key_migration_plan(listing, mapping).collect()] == [
        ("b.html", None, "already_migrated")]


def test_migrated_pages(spark, plan):
    pages = pairs(spark, [("o1", "x"), ("o2", "y"), ("n2", "z")], ("link_hash", "html_data"))
    assert {tuple(r) for r in keys.migrate_keys(pages, plan).select("link_hash", "html_data").collect()} == {
        ("n1", "x"), ("o2", "y"), ("n2", "z")}
    twice = plan.unionByName(plan.filter("action = 'rename'").withColumn("file_name", F.lit("o9.html")))
    with pytest.raises(keys.KeyAuditError, match="same target"):
        keys.migrate_keys(pages, twice)


def test_an_old_name_with_two_new_ones_stops(spark):
    mapping = spark.createDataFrame([("o.html", "n1.html"), ("o.html", "n2.html"), ("p.html", "q.html")],
                                    "old_name string, new_name string")
    listing = spark.createDataFrame([("o.html",), ("p.html",)], "file_name string")
    plan = keys.key_migration_plan(listing, mapping)
    assert sorted((r.file_name, r.action) for r in plan.collect()) == [("o.html", "ambiguous"), ("p.html", "rename")]
    pages = spark.createDataFrame([("o",), ("p",)], "link_hash string")
    with pytest.raises(keys.KeyAuditError):
        keys.migrate_keys(pages, plan)


def test_a_bad_key_stops_the_plans(spark):
    stored = spark.createDataFrame([("a", "wrong")], "link string, link_hash string")
    audit = keys.key_audit(stored, spark.createDataFrame([("a", "right")], "link string, link_hash string"))
    mapping = spark.createDataFrame([("o.html", "n.html")], "old_name string, new_name string")
    with pytest.raises(keys.KeyAuditError):
        keys.key_migration_plan(mapping.select(mapping.old_name.alias("file_name")), mapping, audit)
