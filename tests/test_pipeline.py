"""Files in, files out: the whole pipeline and its readers and writers."""

import csv
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import links as L
from evenkeel.operators import balance, crawl, examples, links, pages
from evenkeel.plans import pipeline
from evenkeel.sources import staging, tables


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """Recipes of 20 websites, one dominant, and pages for most of them."""
    path = tmp_path_factory.mktemp("source") / "recipes.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["", "title", "ingredients", "directions", "link", "source", "NER"])
        i = 0
        for site in range(20):
            for page in range(60 if site == 0 else 4 + site % 3):
                directions = json.dumps([f'Say "{page}", then\nstir; serve.'])
                prefix = "www." if page % 2 else ""
                writer.writerow([i, f"T{i}", '["salt, fine"]', directions, f"{prefix}s{site}.com/p{page}",
                                 "Gathered", "[]"])
                i += 1
    return str(path)


def test_csv_with_quotes(spark, source):
    row = tables.read_recipes(spark, source).filter("title = 'T0'").first()
    assert row.link == "s0.com/p0" and row.ingredients == '["salt, fine"]'
    assert json.loads(row.directions) == ['Say "0", then\nstir; serve.']


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('title,ingredients,directions,link\n"a\nb","i ""x"", y",d,l.com/\n')
    row = tables.read_recipes(spark, str(path)).first()
    assert (row.title, row.ingredients, row.link) == ("a\nb", 'i "x", y', "l.com/")


def test_csv_with_a_schema(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("title,n\na,1\nb,x\n")
    schema = T.StructType.fromDDL("title string, n int, _corrupt_record string")
    rows = tables.read_recipes(spark, str(path), schema).collect()
    assert [tuple(r) for r in rows] == [("a", 1, None), ("b", None, "b,x")]


def test_written_batches_are_in_order(spark, tmp_path):
    df = spark.range(100).select("id", F.array("id").alias("input_ids"), F.array("id").alias("labels"))
    batches = examples.training_batches(df, "id", 8)
    tables.write_batches(batches, f"{tmp_path}/b", per_block=5)
    for block in range(3):
        got = spark.read.parquet(f"{tmp_path}/b/block={block}").collect()
        assert [r.position for r in got] == list(range(block * 40 + 1, min(block * 40 + 40, 100) + 1))


def test_whole_pipeline(spark, source, tmp_path):
    recipes = tables.read_recipes(spark, source)
    prepared = pipeline.prepare_dataset(recipes)
    assert prepared.rejected.count() == 0
    tables.write_prepared(prepared.dataset, f"{tmp_path}/prepared")
    dataset = tables.read_prepared(spark, f"{tmp_path}/prepared")
    sizes = Counter((r.website, r.train) for r in dataset.collect())
    assert sum(not train for _, train in sizes) == 16
    assert {(n, train) for (_, train), n in sizes.items()} == {(4, False), (6, True)}

    cache = tmp_path / "cache"
    cache.mkdir()
    for i, r in enumerate(dataset.orderBy("link").collect()):
        if i % 9:
            (cache / f"{r.link_hash}.html").write_text(
                f"<html><script>x</script><p>{r.link}\n| é</p></html>", encoding="utf-8")
    (cache / "notes.txt").write_text("no page")
    raw = tables.read_page_files(spark, str(cache))
    assert raw.count() == len(list(cache.glob("*.html")))
    tables.write_page_table(pages.page_table(raw), f"{tmp_path}/pages")
    table = tables.read_page_table(spark, f"{tmp_path}/pages")

    tables.write_training(pipeline.merge_pages(dataset, table), f"{tmp_path}/training")
    training = tables.read_training(spark, f"{tmp_path}/training", row_ids=True)
    rows = training.collect()
    assert len({r.row_id for r in rows}) == len(rows) > 0
    assert all(r.input.role == "user" and r.input.content == f"<html><p>{r.link} é</p></html>"
               for r in rows)
    held = {w for w, train in sizes if not train}
    assert all(r.train == (r.website not in held) for r in rows)
    assert len(set(Counter(r.website for r in rows).values())) == 1

    batches = examples.training_batches(pipeline.tokenized_examples(training), "row_id")
    assert batches.filter("size(input_ids) != size(labels) or size(labels) != size(attention_mask)"
                          ).isEmpty()
    assert batches.count() == len(rows)

    listing = tables.read_listing(spark, str(cache))
    plan = crawl.crawl_plan(links.unique_links(dataset), listing, tables.read_failed_log(
        spark, f"{tmp_path}/none"), None)
    assert plan.filter("status = 'cached'").count() == raw.count()


def test_failed_log(spark, tmp_path):
    path = f"{tmp_path}/failed"
    assert tables.read_failed_log(spark, path).count() == 0
    for urls in (["http://a", "http://b"], ["http://b"]):
        tables.append_failed_log(spark.createDataFrame([(u,) for u in urls], "url string"), path)
    (tmp_path / "failed" / "extra.txt").write_text("  http://c \n\n 　\n")
    assert {r.url for r in tables.read_failed_log(spark, path).collect()} == {
        "http://a", "http://b", "http://c"}


def test_split_reader_skips_the_other_split(spark, tmp_path):
    rows = [("l", "w", "h", "r", True), ("m", "w", "i", "r", False)]
    df = spark.createDataFrame(rows, "link string, website string, link_hash string, response string, "
                                     "train boolean")
    tables.write_prepared(df, f"{tmp_path}/p")
    train = tables.read_prepared(spark, f"{tmp_path}/p").filter("train")
    assert [r.link for r in train.collect()] == ["l"]
    assert "PartitionFilters: [isnotnull(train" in train._jdf.queryExecution().executedPlan().toString()


def test_page_html_is_read_once_and_not_for_keys(spark, tmp_path):
    rows = [(f"k{i}", f"<p>{i}</p>") for i in range(50)]
    tables.write_page_table(spark.createDataFrame(rows, "link_hash string, html_data string"),
                            f"{tmp_path}/pages")
    table = tables.read_page_table(spark, f"{tmp_path}/pages")
    dataset = spark.createDataFrame([("l", "w", "k1", "r")],
                                    "link string, website string, link_hash string, response string")
    semi = pages.scraped_only(dataset, table)._jdf.queryExecution().executedPlan().toString()
    assert "html_data" not in semi
    merged = pipeline.merge_pages(dataset, table)._jdf.queryExecution().executedPlan().toString()
    assert sum("html_data" in line for line in merged.splitlines() if "FileScan" in line) == 1


def test_attach_pages_keeps_copies(spark):
    dataset = spark.createDataFrame([("l", "w", "k", "r")] * 3,
                                    "link string, website string, link_hash string, response string")
    table = spark.createDataFrame([("k", "<p>")], "link_hash string, html_data string")
    assert pages.attach_pages(dataset, table).count() == 3


def test_staging_uses_the_session_folder(spark):
    folder = staging.shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = staged = staging.staged(spark.range(5), "t")
    assert folder in df.inputFiles()[0] and staged.count() == 5


def test_staging_without_a_setting(spark, monkeypatch):
    class Unset:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master, folder, applicationId = "local[2]", None, "an application"
            getCheckpointDir = classmethod(lambda cls: cls.folder)

    first = staging.shared_dir(Unset)
    assert first == staging.shared_dir(Unset)
    assert Unset.sparkContext.folder is None
    Unset.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Unset)


def test_metric_points_by_run(spark, tmp_path):
    points = spark.createDataFrame([("r1", 60, 1, "t", 1.0), ("r2", 60, 1, "t", 2.0)],
                                   "run string, tick long, step long, tag string, value double")
    tables.write_points(points, f"{tmp_path}/points")
    assert spark.read.parquet(f"{tmp_path}/points").filter("run = 'r2'").first().value == 2.0


def test_rejected_and_split_cover_all_rows(spark, source):
    keyed = pipeline.keyed_recipes(tables.read_recipes(spark, source)).withColumn(
        "website", F.when(F.col("link") != "www.s1.com/p1", L.website_of(F.col("link"))))
    train, held = balance.compute_dataset_split(keyed)
    assert train.count() + held.count() + balance.rejected_rows(keyed).count() == keyed.count()
    assert balance.rejected_rows(keyed).count() == 1
