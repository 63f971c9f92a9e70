"""A stream of page files follows lists of their names; the driver does not know each page."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from evenkeel.sources import files, page_files
from evenkeel.streaming import pages as live_pages


@pytest.fixture
def cache(tmp_path):
    folder = tmp_path / "cache"
    folder.mkdir()
    return folder


def put(cache, *keys, text="<p>{}</p>"):
    for key in keys:
        (cache / f"{key}.html").write_text(text.format(key))


def lists(cache):
    return [pq.read_table(f)["name"].to_pylist() for f in sorted((cache / "_lists").glob("*.parquet"))]


def convert(spark, cache, tmp_path, per_trigger=10):
    stream = live_pages.stream_page_files(spark, str(cache), per_trigger)
    live_pages.convert_pages(stream, f"{tmp_path}/table", f"{tmp_path}/state", available_now=True).awaitTermination()
    return sorted(tuple(r) for r in live_pages.read_pages(spark, f"{tmp_path}/table").collect())


def test_the_driver_follows_lists(spark, cache, tmp_path):
    put(cache, *(f"k{i:02d}" for i in range(25)))
    expected = [(f"k{i:02d}", f"<p>k{i:02d}</p>") for i in range(30)]
    assert convert(spark, cache, tmp_path) == expected[:25]
    assert [len(names) for names in lists(cache)] == [10, 10, 5]
    put(cache, *(f"k{i:02d}" for i in range(20, 30)))  # half of them are there already
    assert convert(spark, cache, tmp_path) == expected
    assert [len(names) for names in lists(cache)] == [10, 10, 5, 5]
    assert sorted(n for names in lists(cache) for n in names) == [f"k{i:02d}.html" for i in range(30)]
    log = [f for f in (tmp_path / "state" / "sources" / "0").iterdir() if not f.name.startswith(".")]
    assert len(log) == 4 and not any(".html" in f.read_text() for f in log)
    assert not [f for f in (cache / "_lists").iterdir() if f.name.startswith(".part")]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    assert not [x for x in spark.streams._jsqm.listListeners() if "Python" in x.getClass().getName()]


def test_page_files_of_all_kinds(spark, cache, tmp_path):
    put(cache, "a", "_b=1", "with blank", text="é | \n{}")
    put(cache, "_hidden", ".a.part")
    (cache / "empty.html").touch()
    (cache / "notes.txt").write_text("no page")
    (cache / "folder.html").mkdir()
    (cache / "raw.html").write_bytes(b"x\xff\x00\r\ny")
    assert convert(spark, cache, tmp_path) == [
        ("_b=1", "é _b=1"), ("a", "é a"), ("raw", "x�\x00\r y"), ("with blank", "é with blank")]


def test_another_process_lists_as_well(spark, cache, monkeypatch):
    put(cache, *"abcdef")
    real, calls = files.publish, []

    def publish(spark, part, path):
        if not calls:  # the other one is first
            pq.write_table(pa.table({"name": ["a.html", "b.html"]}), path)
        calls.append(path)
        return real(spark, part, path)

    monkeypatch.setattr(files, "publish", publish)
    page_files.list_new_pages(spark, str(cache), 3)
    assert [len(names) for names in lists(cache)] == [2, 3, 1]
    assert sorted(n for names in lists(cache) for n in names) == [f"{k}.html" for k in "abcdef"]


def test_oldest_pages_first(spark, cache):
    put(cache, *"abcd")
    for age, key in enumerate("cadb"):
        os.utime(cache / f"{key}.html", (1e9 - age, 1e9 - age))
    page_files.list_new_pages(spark, str(cache), 2)
    assert lists(cache) == [["b.html", "d.html"], ["a.html", "c.html"]]


def test_a_stream_that_goes_on_finds_new_pages(spark, cache, tmp_path):
    table = f"{tmp_path}/table"

    def wait(count):
        until = time.time() + 60
        while live_pages.read_pages(spark, table).count() < count and time.time() < until:
            time.sleep(0.5)
        return sorted(r.link_hash for r in live_pages.read_pages(spark, table).collect())

    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "1000")
    try:
        stream = live_pages.stream_page_files(spark, str(cache), 10)
        query = live_pages.convert_pages(stream, table, f"{tmp_path}/state")
        try:
            put(cache, "a", "b")
            assert wait(2) == ["a", "b"]
            put(cache, "c")
            assert wait(3) == ["a", "b", "c"]
        finally:
            query.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")


def test_a_checkpoint_that_names_pages_is_refused(spark, cache, tmp_path):
    put(cache, "a")
    log = tmp_path / "state" / "sources" / "0"
    log.mkdir(parents=True)
    (log / "0").write_text(f'v1\n{{"path":"file://{cache}/a.html","timestamp":1,"batchId":0}}')
    with pytest.raises(ValueError, match="names each page"):
        convert(spark, cache, tmp_path)


def test_a_new_stream_meets_old_lists(spark, cache, tmp_path):
    put(cache, "a", "b", "c")
    assert len(convert(spark, cache, tmp_path)) == 3
    (cache / "b.html").unlink()
    put(cache, "d")
    (tmp_path / "again").mkdir()
    assert [key for key, _ in convert(spark, cache, tmp_path / "again")] == ["a", "c", "d"]


def test_a_pattern_is_left_to_spark(spark, cache, tmp_path):
    put(cache, "a", "b")
    assert not page_files.is_listable(f"{tmp_path}/ca*") and not page_files.is_listable("viewfs://store/cache")
    stream = live_pages.stream_page_files(spark, f"{tmp_path}/ca*", 10)
    live_pages.convert_pages(stream, f"{tmp_path}/table", f"{tmp_path}/state", available_now=True).awaitTermination()
    assert live_pages.read_pages(spark, f"{tmp_path}/table").count() == 2
    assert not (cache / "_lists").exists()
