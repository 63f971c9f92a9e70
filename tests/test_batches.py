"""Batch folders and their merge, converted pages, retry events, sketches, buckets."""

import hashlib
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from evenkeel.operators import crawl, statistics
from evenkeel.sources import batches, buckets, files, page_files, shuffled, tables
from evenkeel.streaming import crawl as live
from evenkeel.streaming import pages as live_pages
from evenkeel.streaming import retries

START = datetime(2024, 1, 1)
NUMBERS = "n long"


def put(spark, root, batch, *values):
    batches.write_batch(spark.createDataFrame([(v,) for v in values], NUMBERS), root, batch)


def rows(spark, root):
    return sorted(r.n for r in batches.read_batches(spark, root, NUMBERS).collect())


def total(df):
    return df.agg(F.sum("n").alias("n"))


def test_a_merge_shows_each_batch_once(spark, tmp_path):
    root = f"{tmp_path}/table"
    assert rows(spark, root) == [] and batches.compact(spark, root, NUMBERS) == []
    for n in range(5):
        put(spark, root, n, n, 10 * n)
    put(spark, root, 4, 4, 40)  # run again
    before = rows(spark, root)
    reader = batches.read_batches(spark, root, NUMBERS)  # opened before the merge
    gone = batches.compact(spark, root, NUMBERS, fan=3)
    assert gone == ["batch=0", "batch=1", "batch=2"] and len(batches.live(spark, root).folders()) == 3
    assert rows(spark, root) == before == sorted(r.n for r in reader.collect())
    put(spark, root, 1, 999)  # a batch that is merged already, run again
    assert rows(spark, root) == before
    put(spark, root, 5, 5)
    assert batches.compact(spark, root, NUMBERS, fan=3) == ["batch=3", "batch=4", "batch=5"]
    assert sorted(batches.vacuum(spark, root)) == [f"batch={n}" for n in range(6)]
    assert rows(spark, root) == sorted([*before, 5])
    assert batches.vacuum(spark, root) == []


def test_levels_are_merged_in_turn(spark, tmp_path):
    root = f"{tmp_path}/sums"
    for n in range(9):
        put(spark, root, n, 1)
        batches.compact(spark, root, NUMBERS, total, fan=2)
        assert sum(rows(spark, root)) == n + 1
    assert rows(spark, root) == [1, 8]  # eight batches in a folder of the third level
    batches.vacuum(spark, root)
    assert rows(spark, root) == [1, 8] and len(files.names(spark, f"{root}/_live")) == 1


def test_a_batch_without_mark_and_an_overtaken_merge_do_not_count(spark, tmp_path):
    root = f"{tmp_path}/table"
    for n in range(3):
        put(spark, root, n, n)
    (tmp_path / "table" / "batch=2" / "_SUCCESS").unlink()
    assert rows(spark, root) == [0, 1]
    assert files.publish_text(spark, f"{root}/_live/00000001.json", '{"through": -1, "merged": []}')
    assert not files.publish_text(spark, f"{root}/_live/00000001.json", "else")
    assert rows(spark, root) == [0, 1]


PAGES = {f"k{i}": f"<p>page {i}</p><script>x</script>\n\nend" for i in range(40)}


def cached(spark, path, names):
    frame = spark.createDataFrame([(n, PAGES[n]) for n in names], "link_hash string, html string")
    return page_files.write_page_files(frame, path)


def test_pages_are_converted_once(spark, tmp_path):
    cache, table, state = f"{tmp_path}/cache", f"{tmp_path}/table", f"{tmp_path}/state"

    def convert():
        live_pages.convert_pages(live_pages.stream_page_files(spark, cache, 15), table, state, available_now=True).awaitTermination()
        return {r.link_hash: r.html_data for r in live_pages.read_pages(spark, table).collect()}

    names = sorted(PAGES)
    assert cached(spark, cache, names[:20]) == 20
    (tmp_path / "cache" / "notes.txt").write_text("no page")
    first = convert()
    assert first == {n: f"<p>page {n[1:]}</p> end" for n in names[:20]}
    folders = batches.live(spark, table).batches
    assert len(folders) == 2 and convert() == first and batches.live(spark, table).batches == folders
    cached(spark, cache, names[20:])
    assert set(convert()) == set(names)
    live_pages.compact_pages(spark, table, fan=2)
    batches.vacuum(spark, table)
    assert live_pages.read_pages(spark, table).count() == 40


def test_row_groups_are_bounded(spark, tmp_path):
    many = spark.range(1300).coalesce(1).selectExpr("cast(id as string) link_hash", "'<p>x</p>' html")
    from evenkeel.operators.pages import page_table

    batches.write_batch(page_table(many), f"{tmp_path}/t", 0, **live_pages.OPTIONS)
    sizes = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in (tmp_path / "t" / "batch=0").glob("*.parquet")
             for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(sizes) == 1300 and max(sizes) <= live_pages.PAGE_GROUP_ROWS + 100


def test_page_files_of_edges(spark, tmp_path):
    frame = spark.createDataFrame([("a", "é\n"), ("b", None), (None, "lost"), ("a", "é\n")], "link_hash string, html string")
    page_files.write_page_files(frame, f"{tmp_path}/cache")
    assert {tuple(r) for r in tables.read_page_files(spark, f"{tmp_path}/cache").collect()} == {("a", "é\n")}
    assert (tmp_path / "cache" / "b.html").read_bytes() == b""
    assert page_files.write_page_files(frame.filter("false"), f"{tmp_path}/empty") == 0


def attempts(spark, items):
    return spark.createDataFrame([("r", START + timedelta(seconds=s), u, a, k, 200, 1) for u, a, k, s in items], tables.ATTEMPTS)


def test_retry_events_of_late_and_repeated_files(spark, tmp_path):
    log, out, state = f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/state"
    parts = [[("u1", 1, "failed", 0), ("u2", 1, "failed", 1), ("u3", 1, "saved", 2), ("u4", 2, "failed", 90)],
             [("u1", 1, "failed", 0), ("u2", 2, "failed", 50), ("u5", 1, "failed", 60), ("u6", 1, "failed", 61)],
             [("u2", 2, "failed", 50), ("u4", 1, "failed", 3), ("u6", 2, "saved", 70), ("u7", 1, None, 5)]]

    def run(delay):
        stream = live.stream_attempts(spark, log, files_per_trigger=1)
        retries.watch_retries(stream, out, state, delay, available_now=True).awaitTermination()
        found = [(r.url, r.event, r.first_failure) for r in retries.read_events(spark, out).collect()]
        assert len(found) == len(set(found))
        return set(found)

    for part in parts:  # a run that ends and starts again after each file
        attempts(spark, part).coalesce(1).write.mode("append").parquet(log)
        events = run(3_600_000)
    assert {u for u, e, _ in events if e == retries.FAILED} == {"u2", "u4"} and len(events) == 2
    all_of = attempts(spark, [x for part in parts for x in part])
    batch = crawl.crawl_outcome(all_of)
    assert {r.url for r in batch.filter("outcome = 'failed_permanently'").collect()} == {"u2", "u4"}
    # A watch without delay on the same log: those that wait are due.
    attempts(spark, [x for part in parts for x in part]).coalesce(1).write.parquet(f"{tmp_path}/whole")
    log, out, state = f"{tmp_path}/whole", f"{tmp_path}/out2", f"{tmp_path}/state2"
    due = {(u, t) for u, e, t in run(0) if e == retries.DUE}
    assert due == {(r.url, r.first_failure) for r in batch.filter("outcome = 'retry_pending'").collect()} != set()


def test_links_of_a_bucket_share_a_state(spark, tmp_path):
    rng = random.Random(7)
    kinds = ["failed", "saved", "responded", None]
    items = [(f"u{rng.randrange(150)}", rng.choice([1, 2, None]), rng.choice(kinds), rng.randrange(900)) for _ in range(300)]
    whole = attempts(spark, [*items, *[(f"v{i}", 1, "responded", i) for i in range(400)]]).select(
        F.when(F.col("url") != "u1", "r").alias("run"), "ts", F.when(F.col("url") != "u2", F.col("url")).alias("url"),
        "attempt", "kind", "status", "bytes")
    whole.repartition(3, "ts").write.parquet(f"{tmp_path}/log")
    query = retries.watch_retries(live.stream_attempts(spark, f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/state", 0,
                                  available_now=True, buckets=4)
    query.awaitTermination()
    # A state per bucket and its timers, whatever the number of links.
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 4 * 3
    found = [tuple(r) for r in retries.read_events(spark, f"{tmp_path}/out").collect()]
    states = crawl.outcome_states(whole.withColumn("kind", F.coalesce("kind", F.lit("")))).na.fill(False)
    due = states.filter("failed_once and not saved and not retried")
    failed = states.filter("failed_twice and not saved")
    expected = {(r.run, r.url, event, r.first_failure) for event, rows in ((retries.DUE, due), (retries.FAILED, failed))
                for r in rows.collect()}
    assert len(found) == len(expected) and set(found) == expected
    assert {event for _, _, event, _ in found} == {retries.DUE, retries.FAILED}


def test_points_at_each_hundredth_save(spark, tmp_path):
    items = [(f"u{i}", 1, "saved" if i % 5 else "failed", i) for i in range(700)]
    for i in range(0, 700, 140):
        attempts(spark, items[i:i + 140]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    listener = live.ProgressListener()
    spark.streams.addListener(listener)
    try:
        stream = live.observe_stream(live.stream_attempts(spark, f"{tmp_path}/log", files_per_trigger=1))
        query = (stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/state")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
    assert [saved for saved, *_ in listener.points] == [100, 200, 300, 400, 500]
    assert listener.saved == 560 and listener.points[0][2] == 0


def test_merged_sketches_keep_their_rank_error(spark):
    rng = random.Random(5)
    lengths = [int(rng.lognormvariate(4, 1)) for _ in range(6000)]
    texts = spark.createDataFrame([("x " * n, i % 13) for i, n in enumerate(lengths)] + [(None, 1)], "text string, part int")
    parts = statistics.length_sketches(texts, F.col("text"), F.col("part"))
    once = statistics.merged_lengths(parts)
    twice = statistics.merged_lengths(statistics.merged_lengths(parts, F.substring("batch", 1, 1)))
    lengths.sort()
    for merged in (once, twice):
        row = merged.select("rows", "tokens", "max_tokens", *[statistics.length_quantile(q).alias(f"q{int(q * 100)}")
                                                              for q in (0.1, 0.5, 0.9)]).first()
        assert (row.rows, row.tokens, row.max_tokens) == (6000, sum(lengths), lengths[-1])
        for q in (0.1, 0.5, 0.9):
            value = row[f"q{int(q * 100)}"]
            below, upto = (sum(n < value for n in lengths) / 6000, sum(n <= value for n in lengths) / 6000)
            assert below - statistics.RANK_ERROR <= q <= upto + statistics.RANK_ERROR
    assert statistics.merged_stats(parts.filter("false")).count() == 0


def test_bucketed_tables_in_another_catalogue(spark, tmp_path):
    frame = spark.range(50).selectExpr("md5(cast(id as string)) link_hash", "id")
    buckets.write_bucketed(frame, "bucketed_once", f"{tmp_path}/t", buckets=4)
    spark.sql("DROP TABLE bucketed_once")
    again = buckets.open_bucketed(spark, "bucketed_again", f"{tmp_path}/t", "link_hash string, id long", buckets=4)
    assert again.count() == 50
    plan = again.groupBy("link_hash").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_again")
    key = hashlib.md5(b"7").hexdigest()
    assert again.sparkSession.read.parquet(f"{tmp_path}/t").filter(F.col("link_hash") == key).first().id == 7


def test_a_page_table_is_a_listing(spark):
    table = spark.createDataFrame([("k1", "x"), ("k2", "y")], "link_hash string, html_data string")
    assert [r.file_name for r in tables.page_listing(table).collect()] == ["k1.html", "k2.html"]


def test_files_in_name_order_are_the_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "concat('t', id) text").repartition(7)
    shuffled.write_shuffled(rows, "id", f"{tmp_path}/one", rows_per_file=90)
    shuffled.write_shuffled(rows.repartition(3), "id", f"{tmp_path}/two", rows_per_file=90)
    folders = sorted((tmp_path / "one").glob("start=*"))
    taken = [i for folder in folders for f in sorted(folder.glob("*.parquet")) for i in pq.ParquetFile(f).read()["id"].to_pylist()]
    expected = sorted(range(1000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert taken == expected and len(folders) > 8 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    for name in ("one", "two"):
        found = shuffled.read_shuffled(spark, f"{tmp_path}/{name}", rows.schema).collect()
        assert [r.id for r in sorted(found, key=lambda r: r.position)] == expected
    rest = shuffled.read_shuffled(spark, f"{tmp_path}/one", rows.schema, after=700)
    assert sorted(r.position for r in rest.collect()) == list(range(701, 1001))
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start" in plan  # earlier files are not read
    assert shuffled.read_shuffled(spark, f"{tmp_path}/one", rows.schema, after=1000).count() == 0


@pytest.mark.parametrize("path", ["file:{}", "file://{}", "{}"])
def test_addresses_of_folders(tmp_path, path):
    system, folder = page_files._folder(path.format(tmp_path / "new"))
    assert folder == str(tmp_path / "new") and system.type_name == "local"
