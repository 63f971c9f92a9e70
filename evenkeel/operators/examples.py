"""Training examples: prompts, token ids, labels, batches, token statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions import chat as C
from evenkeel.functions import patterns as P
from evenkeel.operators.ranking import BUCKET, ORDER, bucketed, seeded_positions

BATCH_SIZE = 8
SHUFFLE_SEED = 42
SAMPLE_PAGES = 500
SHARD_DIGITS = 15


def decode_messages(df: DataFrame, column: str = "input") -> DataFrame:
    """A JSON message string to a list of one message."""
    return df.withColumn(column, F.array(F.from_json(F.col(column), C.MESSAGE)))


def encode_message(df: DataFrame, column: str = "input") -> DataFrame:
    """A message struct to a JSON string."""
    return df.withColumn(column, F.to_json(F.col(column), {"ignoreNullFields": "false"}))


def chat_render(df: DataFrame, messages: str = "input",
                template: C.ChatTemplate = C.CHATML) -> DataFrame:
    """Add `prompt`, rendered from a list of messages."""
    return df.withColumn("prompt", C.render_prompt(F.col(messages), template))


def tokenize_examples(df: DataFrame, tokenizer: C.HashTokenizer = C.HASH_TOKENIZER) -> DataFrame:
    """Add `prompt_ids`, and `response_ids` that end with the end token."""
    return tokenize_responses(tokenize_prompts(df, tokenizer), tokenizer)


def tokenize_prompts(df: DataFrame, tokenizer: C.HashTokenizer = C.HASH_TOKENIZER) -> DataFrame:
    """Add `prompt_ids`. Where several answers share a prompt, tokenize it before they are joined to it."""
    return df.withColumn("prompt_ids", tokenizer.ids(F.col("prompt")))


def tokenize_responses(df: DataFrame, tokenizer: C.HashTokenizer = C.HASH_TOKENIZER) -> DataFrame:
    """Add `response_ids` that end with the end token."""
    end = F.array(F.lit(tokenizer.eos_id))
    return df.withColumn("response_ids", F.concat(tokenizer.ids(F.col("response")), end))


def model_token_ids(load_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]]):
    """A pandas UDF from text to token ids around a model's own tokenizer.

    `load_tokenizer` runs once per task, e.g. to read a tokenizer file.
    """
    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_tokenizer()
        for texts in batches:
            known = texts.notna()
            encoded = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            encoded[known] = pd.Series(encode(texts[known].tolist()), index=texts.index[known],
                                       dtype=object)
            yield encoded

    return ids


def tokenize_with_model(df: DataFrame, load_tokenizer, eos_token: str) -> DataFrame:
    """`tokenize_examples` with a model's tokenizer; the end token is appended as text."""
    ids = model_token_ids(load_tokenizer)
    return (df.withColumn("prompt_ids", ids(F.col("prompt")))
            .withColumn("response_ids", ids(F.concat("response", F.lit(eos_token)))))


def conversation_input(turns: DataFrame, conversation: str, turn: str, role: Column,
                       content: Column) -> DataFrame:
    """(conversation, input): the messages of each conversation in order of `turn`, equal turns by text.

    A conversation is one row afterwards, and so must fit a task.
    """
    message = F.struct(F.col(turn).alias("turn"), role.alias("role"), content.alias("content"))
    listed = turns.groupBy(conversation).agg(F.array_sort(F.collect_list(message)).alias("input"))
    return listed.withColumn("input", F.transform("input", lambda m: C.message(m["role"], m["content"])))


def label_mask(df: DataFrame) -> DataFrame:
    """Add `input_ids` and `labels`; the prompt's labels are ignored by the loss."""
    prompt, response = F.col("prompt_ids"), F.col("response_ids")
    return (df.withColumn("input_ids", C.example_ids(prompt, response))
            .withColumn("labels", C.example_labels(prompt, response))
            .drop("prompt_ids", "response_ids"))


def join_examples(df: DataFrame) -> DataFrame:
    """Add `input_ids` and `prompt_size`: what labels are made of, at half their size."""
    prompt = F.col("prompt_ids")
    return (df.withColumn("input_ids", C.example_ids(prompt, F.col("response_ids")))
            .withColumn("prompt_size", F.size(prompt)).drop("prompt_ids", "response_ids"))


def training_batches(df: DataFrame, key: str, size: int = BATCH_SIZE, seed: int = SHUFFLE_SEED,
                     pad_id: int = C.HASH_TOKENIZER.pad_id, side: str = "right", per_shard: int = 1,
                     before: str | None = None) -> DataFrame:
    """Rows in seeded order, in batches padded to their longest row.

    Adds `position` (from 1), `batch` (from 0) and `attention_mask`, and `labels`
    where `df` has a `prompt_size` instead: they are then made behind the
    shuffle. `key` must name one row. The keys alone are ranked first, to cut the order into shards
    of `per_shard` batches (or of a digest bucket, if that has more). The examples are
    then shuffled once, by shard, and sorted once: a batch finds its width among
    the lengths around each row. `before` names a column for the number of rows before the shard.
    """
    sharded = in_batch_shards(df, key, size, seed, per_shard).withColumn("_size", F.size("input_ids"))
    in_shard = Window.partitionBy("_shard").orderBy(ORDER, key)
    around = F.collect_list(F.coalesce("_size", F.lit(0))).over(in_shard.rowsBetween(1 - size, size - 1))
    placed = (sharded.select("*", F.row_number().over(in_shard).alias("_row"), around.alias("_around"))
              .withColumn("position", F.col("_start") + F.col("_row") - 1)
              .withColumn("batch", F.floor((F.col("position") - 1) / size)))
    # The row's own place in `_around`, less those of its batch before it.
    first = F.least("_row", F.lit(size)) - ((F.col("position") - 1) % size).cast("int")
    labelled = placed.withColumn("_width", F.array_max(F.slice("_around", first, F.lit(size))))
    to = F.col("_width")
    ones = F.array_repeat(F.lit(1), F.col("_size"))
    if "labels" not in df.columns:
        labels = C.masked_labels(F.col("input_ids"), F.col("prompt_size"))
        labelled = labelled.withColumn("labels", labels).drop("prompt_size")
    padded = (labelled.withColumn("attention_mask", C.padded(ones, to, 0, side))
              .withColumn("input_ids", C.padded(F.col("input_ids"), to, pad_id, side))
              .withColumn("labels", C.padded(F.col("labels"), to, P.IGNORED_LABEL, side)))
    if before:
        padded = padded.withColumn(before, F.col("_shard"))
    return padded.drop("_size", "_width", "_row", "_around", "_shard", "_start", ORDER)


def in_batch_shards(df: DataFrame, key: str, size: int, seed: int, per_shard: int = 1) -> DataFrame:
    """Add the digest order, `_shard` (the rows before it) and the position `_start` of its first row.

    A digest bucket starts a shard at its first row whose position opens
    a batch, the first of `per_shard`; the rows before it belong to the shard before.
    """
    ranked = seeded_positions(df.select(key), key, seed)
    opens = F.when((F.col("position") - 1) % (size * per_shard) == 0, F.struct("position", ORDER))
    starts = ranked.groupBy(BUCKET).agg(F.min(opens).alias("own"))
    # 65,536 buckets at most, in one small window and one broadcast.
    earlier = F.last("own", ignorenulls=True).over(
        Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    shards = starts.select(BUCKET, "own", earlier.alias("earlier"))
    first_of_own = F.col("own").isNotNull() & (F.col(ORDER) >= F.col("own")[ORDER])
    start = F.when(first_of_own, F.col("own.position")).otherwise(F.col("earlier.position"))
    return (bucketed(df, key, seed).join(F.broadcast(shards), BUCKET)
            .withColumn("_start", start).withColumn("_shard", shard_name(F.col("_start")))
            .drop("own", "earlier", BUCKET))


def shard_name(start: Column) -> Column:
    """The number of rows before a position as text that sorts like the number."""
    return F.coalesce(F.lpad((start - 1).cast("string"), SHARD_DIGITS, "0"), F.lit(""))


def token_stats(texts: DataFrame, text: Column, tokenizer: C.HashTokenizer = C.HASH_TOKENIZER,
                first: int | None = None, key: str | None = None) -> DataFrame:
    """Max, mean and median token count with the rough attention size in bytes.

    The counts are grouped by length first, so the median works on distinct
    lengths. `first` limits the statistics to the first rows by `key`.
    """
    if first is not None:
        # Keys alone are ordered; `first` of them at most are broadcast. A key names one row.
        chosen = texts.select(key).orderBy(key).limit(first)
        texts = texts.join(F.broadcast(chosen), key, "left_semi")
    lengths = (texts.select(tokenizer.count(text).cast("long").alias("tokens"))
               .filter(F.col("tokens").isNotNull())
               .groupBy("tokens").agg(F.count(F.lit(1)).alias("rows")))
    stats = lengths.agg(
        F.sum("rows").alias("rows"), F.max("tokens").alias("max_tokens"),
        (F.sum(F.col("tokens") * F.col("rows")) / F.sum("rows")).alias("mean_tokens"),
        F.percentile("tokens", 0.5, F.col("rows")).alias("median_tokens"))
    return stats.select("*", *[
        attention_bytes(F.col(f"{s}_tokens")).alias(f"attn_matrix_bytes_fp16_{s}")
        for s in ("max", "mean", "median")])


def attention_bytes(tokens: Column) -> Column:
    """Rough size of one half-precision attention matrix; not a memory model."""
    return tokens * tokens * 2
