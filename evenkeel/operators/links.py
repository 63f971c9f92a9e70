"""Link operators: normal form, website, target text, keys, distinct links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import links as L
from evenkeel.functions import text as X


def format_links(df: DataFrame) -> DataFrame:
    """`link` in its normal form."""
    return df.withColumn("link", L.www_link(F.col("link")))


def extract_websites(df: DataFrame, strict_host: bool = False) -> DataFrame:
    """Add `website`, null where the link has none."""
    return df.withColumn("website", L.website_of(F.col("link"), strict_host))


def build_responses(df: DataFrame) -> DataFrame:
    """Add `response` from `title`, `ingredients` and `directions`."""
    parts = (F.col("title"), F.col("ingredients"), F.col("directions"))
    return df.withColumn("response", X.response_text(*parts))


def compute_link_hashes(df: DataFrame) -> DataFrame:
    """Add `link_hash`, the key used for pages and joins."""
    return df.withColumn("link_hash", L.link_hash(F.col("link")))


def unique_links(df: DataFrame) -> DataFrame:
    """Distinct links in normal form with their key; null is no link.

    Copies are combined before the shuffle, so a link that fills a third of
    the rows costs one row per task.
    """
    links = format_links(df.select("link")).filter(F.col("link").isNotNull()).distinct()
    return compute_link_hashes(links)
