"""The table stages in order: prepare, page table, merge, examples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import chat as C
from evenkeel.operators import balance, examples, links, pages, sampling
from evenkeel.sources.staging import BROADCAST_BYTES, staged


@dataclass(frozen=True)
class Prepared:
    dataset: DataFrame
    rejected: DataFrame


def keyed_recipes(recipes: DataFrame) -> DataFrame:
    """(link, website, link_hash, response) from the source columns."""
    df = links.build_responses(links.extract_websites(links.format_links(recipes)))
    return links.compute_link_hashes(df).select("link", "website", "link_hash", "response")


def balance_dataset(keyed: DataFrame, k: int = balance.EVAL_WEBSITES, seed: int = 0,
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hold out `k` websites, then draw equally from each website of a split.

    Adds `train`. The split, both minima and the quotas come from one staged
    histogram; the rows themselves are read for the draw only.
    """
    known = keyed.filter(F.col("website").isNotNull())
    histogram = sampling.group_histogram(known, "website", "link", seed, broadcast_bytes)
    # k rows at most.
    held_out = F.broadcast(balance.smallest_websites(histogram.counts, k)
                           .select("website", F.lit(False).alias("_train")))
    train = F.coalesce("_train", F.lit(True))
    split = histogram.counts.join(held_out, "website", "left").groupBy(train.alias("train"))
    smallest = {r["train"]: r["n"] for r in split.agg(F.min("n").alias("n")).collect()}
    quota = F.when(train, smallest.get(True, 0)).otherwise(smallest.get(False, 0)).cast("long")
    drawn = sampling.draw(known, histogram, quota,
                          histogram.buckets.join(held_out, "website", "left"))
    return drawn.join(held_out, "website", "left").select(*keyed.columns, train.alias("train"))


def prepare_dataset(recipes: DataFrame, k: int = balance.EVAL_WEBSITES, seed: int = 0,
                    broadcast_bytes: int = BROADCAST_BYTES) -> Prepared:
    """Prepared set with `train`, and the rows that have no website."""
    keyed = keyed_recipes(recipes)
    return Prepared(balance_dataset(keyed, k, seed, broadcast_bytes), balance.rejected_rows(keyed))


def merge_pages(dataset: DataFrame, page_table: DataFrame, seed: int = 0,
                broadcast_bytes: int = BROADCAST_BYTES, raw: bool = False) -> DataFrame:
    """Training table: scraped rows, drawn equally per website, with their page.

    Everything up to the last join works on keys and targets; pages are read
    once, for the rows that are left. `raw` pages are not cleaned yet. Runs jobs
    when called.
    """
    scraped = staged(pages.scraped_only(dataset, page_table), "scraped")
    # Written, as its keys are read before its rows.
    drawn = staged(sampling.sample_by_website(scraped, seed=seed, broadcast_bytes=broadcast_bytes), "drawn")
    return pages.attach_pages(drawn, page_table, broadcast_bytes, raw)


def tokenized_examples(training: DataFrame, template: C.ChatTemplate = C.CHATML,
                       tokenizer: C.HashTokenizer = C.HASH_TOKENIZER) -> DataFrame:
    """`input_ids` and `prompt_size` from a training table whose `input` is one message."""
    listed = training.withColumn("input", F.array("input"))
    rendered = examples.chat_render(listed, "input", template).drop("input")
    tokens = examples.tokenize_examples(rendered, tokenizer).drop("prompt", "response")
    return examples.join_examples(tokens)
