"""Page table, pages that are scraped, training table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import chat as C
from evenkeel.functions import text as X
from evenkeel.operators.membership import KeyFilter, members
from evenkeel.sources.staging import BROADCAST_BYTES, staged_with_facts

# Memory of a broadcast key with its place in a hash table.
KEY_BYTES = 32


def page_table(pages: DataFrame, keep_pipes: bool = False) -> DataFrame:
    """(link_hash, html_data) with cleaned HTML from (link_hash, html)."""
    return pages.select("link_hash", X.clean_html(F.col("html"), keep_pipes).alias("html_data"))


def scraped_only(dataset: DataFrame, pages: DataFrame, known: KeyFilter | None = None) -> DataFrame:
    """Rows of the dataset that have a page; only the page keys are read.

    With a filter over the page keys (`membership.key_filter`), rows that surely
    have none go before anything is moved.
    """
    if known is not None:
        return members(dataset, pages, known)
    return dataset.join(pages.select("link_hash"), "link_hash", "left_semi")


def attach_pages(dataset: DataFrame, pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES,
                 raw: bool = False) -> DataFrame:
    """Training table: dataset rows with the page as a user message, `input`.

    Runs a job when called: the dataset's keys are written as numbers of eight
    bytes. If they are small enough to be broadcast, pages are filtered by them
    where they are read, before a page is cleaned or moved; the exact join
    follows. A page key is unique. `raw` pages are (link_hash, html): they are
    cleaned last, for the rows that are left.
    """
    keys, facts = staged_with_facts(dataset.select(F.xxhash64("link_hash").alias("_key")).distinct(), "page-keys",
                                    F.count(F.lit(1)).alias("n"))
    if facts["n"] * KEY_BYTES <= broadcast_bytes:
        pages = pages.join(F.broadcast(keys), F.xxhash64("link_hash") == F.col("_key"), "left_semi")
    joined = dataset.join(pages, "link_hash")
    content = X.clean_html(F.col("html")) if raw else F.col("html_data")
    return joined.select(*dataset.columns, C.message("user", content).alias("input"))
