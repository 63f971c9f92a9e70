from pyspark.sql import functions as F

from evenkeel.functions import links as L
from evenkeel.operators import links as ops


def one(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, link string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("link"))).collect()]


def test_www_prefix(spark):
    given = ["www.a.com/x/", "a.com/x/", None, "WWW.a.com/", ""]
    assert one(spark, given, L.www_link) == [
        "www.a.com/x/", "www.a.com/x/", None, "www.WWW.a.com/", "www."]


def test_website_is_greedy(spark):
    given = ["www.a.com/x/b.php/y", "www.a.com", "www.a.info/x", "www.a.COM/x", None,
             "www.a.co.uk/x", "www.a.com/x\n.de/y", "www.a.com/\r.de/y"]
    assert one(spark, given, L.website_of) == [
        "www.a.com/x/b.php/", None, None, None, None, "www.a.co.uk/", "www.a.com/",
        "www.a.com/\r.de/"]
    strict = one(spark, given[:2], lambda c: L.website_of(c, strict_host=True))
    assert strict == ["www.a.com/", None]


def test_keys(spark):
    import hashlib
    link = "www.a.com/x"
    assert one(spark, [link, None], L.link_hash) == [hashlib.sha256(link.encode()).hexdigest(), None]
    assert one(spark, [link], L.legacy_file) == [
        hashlib.md5(f"http://{link}".encode()).hexdigest() + ".html"]
    assert one(spark, ["k.html", "k.txt", "a.b.html"], L.file_stem) == ["k", "", "a.b"]


def test_response_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("t", "i", "d"), (None, "i", "d"), ("t", "", "d")],
                               "title string, ingredients string, directions string")
    assert [r.response for r in ops.build_responses(df).collect()] == ["t\ni\nd", None, "t\n\nd"]


def test_unique_links(spark):
    df = spark.createDataFrame([("a.com",), ("www.a.com",), (None,), ("b.com",)] * 3, "link string")
    assert sorted(r.link for r in ops.unique_links(df).collect()) == ["www.a.com", "www.b.com"]
