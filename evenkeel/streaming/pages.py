"""Pages as they are crawled: new files become rows of the page table, once each."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from evenkeel.functions import links as L
from evenkeel.operators import pages as page_ops
from evenkeel.sources import batches, files, page_files
from evenkeel.sources.tables import PAGE_GROUP_BYTES

FILES_PER_BATCH = 10_000
PAGE_GROUP_ROWS = 512
PAGES_PER_TASK = 512
PAGES = "link_hash string, html_data string"
OPTIONS = {"compression": "zstd", "parquet.block.size": PAGE_GROUP_BYTES,
           "parquet.block.row.count.limit": PAGE_GROUP_ROWS}


class FolderWatch(StreamingQueryListener):
    """Lists a folder's new pages whenever a stream has nothing to do, until no stream is left."""

    def __init__(self, spark: SparkSession, path: str, per_list: int):
        self.spark, self.path, self.per_list, self.started = spark, path, per_list, False

    def onQueryStarted(self, event) -> None:
        self.started = True

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        page_files.list_new_pages(self.spark, self.path, self.per_list)

    def onQueryTerminated(self, event) -> None:
        if self.started and not self.spark.streams.active:
            self.spark.streams.removeListener(self)


def stream_page_files(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """(link_hash, html) of `<link_hash>.html` files as they appear in a folder.

    Runs a job when called: the files are listed in the folder (`page_files`), and
    the stream follows the lists, so the driver knows a name per list and not per page. A
    stream that goes on lists again when it is idle. Lists are kept for all streams of a
    folder: those of before keep their size, and pages deleted since are passed over. `path` is a folder that all
    executors reach by the same name, or an address that Arrow's file systems know; another
    address, or a pattern, is left to Spark's own file source, which keeps every file in the driver's memory.
    """
    if not page_files.is_listable(path):
        found = (spark.readStream.schema("value string").format("text").option("wholetext", True)
                 .option("pathGlobFilter", "*.html").option("maxFilesPerTrigger", files_per_trigger).load(path))
        return found.select(L.file_stem(F.col("_metadata.file_name")).alias("link_hash"), F.col("value").alias("html"))
    lists = page_files.list_new_pages(spark, path, files_per_trigger)
    spark.streams.addListener(FolderWatch(spark, path, files_per_trigger))
    files.make_folder(spark, lists)
    listed = spark.readStream.schema(page_files.LISTED).option("maxFilesPerTrigger", 1).parquet(lists)
    found = page_files.read_listed(listed, path, -(-files_per_trigger // PAGES_PER_TASK))
    return found.select(L.file_stem(F.col("name")).alias("link_hash"), F.col("content").cast("string").alias("html"))


def convert_pages(pages: DataFrame, root: str, checkpoint: str, available_now: bool = False,
                  keep_pipes: bool = False):
    """Start the conversion of a stream of pages: each micro-batch writes its cleaned pages to a folder of its own.

    A file is converted once: a run that starts again goes on behind the last
    batch, and a batch that did not end overwrites its own folder. Row groups
    are bounded by bytes and by rows, whatever a batch holds. A checkpoint of the
    form before, which names each page, is refused: its pages would come twice.
    """
    _require_lists(pages.sparkSession, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        batches.write_batch(page_ops.page_table(batch, keep_pipes), root, number, **OPTIONS)

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """The page table as far as it is converted."""
    return batches.read_batches(spark, root, PAGES)


def compact_pages(spark: SparkSession, root: str, fan: int = batches.FAN) -> list[str]:
    """Merge the folders of old batches; rows stay as they are."""
    return batches.compact(spark, root, PAGES, None, fan, **OPTIONS)


def _require_lists(spark: SparkSession, checkpoint: str) -> None:
    """Stop if a checkpoint names pages of a folder that is followed by lists now."""
    log = f"{checkpoint}/sources/0"
    for name in [n for n in files.names(spark, log) if not n.startswith(".")][:1]:
        for line in spark.read.text(f"{log}/{name}").head(2):
            page = re.search(r'"path":"([^"]*)/[^"/]*\.html"', line.value)
            if page and files.exists(spark, f"{unquote(page[1])}/{page_files.LISTS}"):
                raise ValueError(f"{checkpoint} names each page, as before lists were kept; convert into a new table")
