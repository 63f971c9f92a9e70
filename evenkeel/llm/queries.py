"""The operators as queries over the given tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    charmodel,
    codes,
    collisions,
    embeddings,
    imatch,
    language,
    licenses,
    mixing,
    negatives,
    oracles,
    packing,
    quality,
    revisits,
    simhash,
    tables,
    toxicity,
)
from evenkeel.llm import vectors as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query; Python workers are told where this package is."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables.ready(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(tables.documents(spark, sf_dir), 3, simhash.exact_index(2))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(tables.documents(spark, sf_dir), packing.public_tokenizer())
    placed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mix_sources(docs).documents.select("doc_id", "size", "source_size", "target", "copies", "taken")


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text")
    learned = tables.labels(spark, sf_dir).filter(~tables.in_fold("doc_id", 3, 1))
    model = quality.fit(tables.training_rows(docs, learned, "quality", quality.MAX_TRAINING))
    return tables.scored(docs.withColumn("score", quality.score(F.col("text"), model)),
                         tables.in_fold("doc_id", 3, 1))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~tables.in_fold("doc_id", 4, 2)))
    found = docs.select("doc_id", tables.in_fold("doc_id", 4, 2).alias("held_out"),
                        language.predict(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text")
    learned = tables.labels(spark, sf_dir).filter(~tables.in_fold("doc_id", 5, 0))
    sample = tables.training_rows(docs, learned, "toxic", toxicity.MAX_TRAINING)
    model = toxicity.fit(sample, charmodel.count(docs))
    return tables.scored(docs.withColumn("score", toxicity.score(F.col("text"), model)),
                         tables.in_fold("doc_id", 5, 0))


@query
def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text")
    return imatch.edited(docs, imatch.lexicon(docs))


@query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(
        f"{sf_dir}/embeddings.parquet")
    return embeddings.near_duplicates(vectors)


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir).select("doc_id", "text", "source")
    return licenses.scan(docs.select("doc_id", "text").unionByName(dressed(docs)), licenses.registry(spark))


def dressed(docs: DataFrame) -> DataFrame:
    """For every 40th document a whole licence in other case, spelling, lines and punctuation, under its source's name."""
    known = F.array(*[F.lit(text) for text in licenses.TEXTS.values()])
    text = F.element_at(known, (F.floor(F.col("doc_id") / 40) % len(licenses.TEXTS) + 1).cast("int"))
    spelled = F.replace(text, F.lit(" license "), F.lit(" licence "))
    changed = F.when(F.col("doc_id") % 80 == 0, F.upper(spelled)).otherwise(F.replace(spelled, F.lit(","), F.lit(" ;")))
    lines = F.replace(changed, F.lit("\n"), F.lit("\r\n  * "))
    return docs.filter("doc_id % 40 = 0").select(
        (-1 - F.col("doc_id")).alias("doc_id"),
        F.concat(F.lit("Copyright (c) 2020 "), F.coalesce("source", F.lit("")), F.lit("\n"), lines).alias("text"))


def captures(pages: DataFrame) -> DataFrame:
    """Records made of each page: three responses over three days, and five revisits between them.

    The second response has no validator, the third a modification time alone.
    """
    when = F.lit(1_700_000_000) + F.col("page_id") % 1000 * 3600
    pages = pages.select("page_id", "url", "html", F.md5("html").alias("digest"),
                         F.concat(F.regexp_replace("url", "^https?://", "HTTP://WWW."), F.lit("#again")).alias("again"))

    def record(number: int, url, ts, kind: str, payload, **fields):
        names = [x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.struct((8 * F.col("page_id") + number).alias("record_id"), url.alias("url"),
                        ts.cast("bigint").alias("ts"), F.lit(kind).alias("kind"),
                        F.create_map(*names).alias("headers"), payload.alias("payload"))

    url, again, digest, none = F.col("url"), F.col("again"), F.col("digest"), F.lit(None).cast("string")
    age = F.concat(F.lit("max-age="), (F.col("page_id") % 7).cast("string"))
    rows = F.array(
        record(0, url, when, "response", F.col("html"), ETag=digest, Content_Type=F.lit("text/html"),
               Content_Length=F.octet_length("html").cast("string")),
        record(1, again, when + 90_000, "revisit", none, etag=F.concat(F.lit('W/"'), digest, F.lit('"')),
               Cache_Control=age, Content_Length=F.lit("0")),
        record(2, url, when, "revisit", none, etag=digest, Cache_Control=F.lit("max-age=1")),
        record(3, url, when + 60, "revisit", none, Cache_Control=F.lit("max-age=2"),
               etag=F.concat(F.lit("stale-"), F.col("page_id").cast("string"))),
        record(4, url, when + 93_600, "response", F.concat("html", F.lit("<!-- again -->")), Content_Type=F.lit("text/html")),
        record(5, again, when + 108_000, "revisit", none, etag=digest, Cache_Control=age),
        record(6, url, when + 180_000, "response", F.concat("html", F.lit("<!-- at last -->")),
               Content_Type=F.lit("text/html"), Last_Modified=F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))),
        record(7, url, when + 190_000, "revisit", none, Cache_Control=F.lit("max-age=3"),
               last_modified=F.concat(F.lit("day "), (F.col("page_id") % 14).cast("string"))))
    return pages.select(F.inline(rows))


@query
def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.schema("page_id bigint, url string, html string").parquet(f"{sf_dir}/pages.parquet")
    found = revisits.resolve(captures(pages))
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("record_id", "ts", "url_key", "response_id", "outcome",
                        F.array_join(pairs, ";").alias("headers"), F.md5("payload").alias("payload_md5"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(V.embeddings(spark, sf_dir))


@query
def op12_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = V.embeddings(spark, sf_dir)
    return collisions.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    vectors = V.embeddings(spark, sf_dir).withColumn("label", moved)
    return negatives.hard_negatives(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLES.update(oracles.SQL)
