"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of `documents`; the last returns a row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import language, mixing, packing, quality, simhash, tables
from evenkeel.sources.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document goes if its language cannot be told, or the closest of the winner's duels is lost.
MIN_CONFIDENCE = 0.5
MIN_QUALITY = 0.5
# Near copies: fingerprints of three-word shingles that differ in at most two bits.
SHINGLE, MAX_BITS = 3, 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; a null text, or one without letters, goes.

    Rows that repeat stay, null ids and sources as well; no rows give no rows.
    """
    tables.ready(spark)
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.filter(~tables.in_fold("doc_id", 4, 2)))
    found = docs.withColumn("_found", language.predict(F.col("text"), model))
    known = (F.col("_found.lang_pred") != language.UNKNOWN) & (F.col("_found.score") >= MIN_CONFIDENCE)
    return found.filter(known).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good; it learns from the labels outside the held-out third.

    A null text is scored like an empty one. Rows that repeat have one score
    and stay or go together; without labels all stay; no rows give no rows.
    """
    tables.ready(spark)
    docs = docs.select(*COLUMNS)
    learned = tables.labels(spark, sf_dir).filter(~tables.in_fold("doc_id", 3, 1))
    model = quality.fit(tables.training_rows(docs, learned, "quality", quality.MAX_TRAINING))
    return docs.filter(quality.score(F.col("text"), model) >= MIN_QUALITY).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, or one without doc_id if none has.

    Each row is a document of its own, also where rows share a doc_id or have
    none; rows that are alike in doc_id and text are one. A null text is an
    empty one. No rows give no rows.
    """
    tables.ready(spark)
    docs = docs.select(*COLUMNS).withColumn("_row", F.xxhash64("doc_id", "text"))
    known = docs.select(F.col("_row").alias("doc_id"), F.col("doc_id").alias("_id"), "text")
    found = simhash.near_duplicates(known, SHINGLE, simhash.exact_index(MAX_BITS), also=("_id",))
    rows = staged(found.groupBy("component_id", F.col("doc_id").alias("_row")).agg(
        F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_rows")), "documents")
    first = rows.groupBy("component_id").agg(
        F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row", "_rows")).alias("first"))
    kept = staged(first.select("first._row", "first._rows"), "kept-documents")
    gone = staged(rows.join(kept, "_row", "left_anti").select("_row"), "gone-documents")
    again = staged(kept.filter("_rows > 1").select("_row"), "repeated-documents")
    left = docs.join(tables.bounded(gone), "_row", "left_anti")
    if again.isEmpty():
        return left.select(*COLUMNS)
    again = tables.bounded(again)
    one = left.join(again, "_row", "left_semi").dropDuplicates(["_row"])
    return left.join(again, "_row", "left_anti").select(*COLUMNS).unionByName(one.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its draw say.

    A null text has no words and never adds to a source; rows that repeat are
    drawn alike; a null source is one of its own; no rows give no rows.
    """
    mixed = mixing.mix_sources(docs.select(*COLUMNS)).documents
    return mixing.repeat(mixed).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and its place there.

    A null text is an empty one: its end mark alone. Rows that repeat, as mixed
    ones do, are packed each; no rows give no rows.
    """
    tables.ready(spark)
    pieces = packing.pieces(docs, packing.public_tokenizer())
    placed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language ID", language_id), ("quality classifier", quality_filter),
          ("SimHash near-dedup", near_dedup), ("mixing sources", mix_sources),
          ("best-fit packing", pack)]

# Language and quality models are not expressible in SQL; tests use brute force and held-out rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; all but the last are written to the shared folder."""
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
