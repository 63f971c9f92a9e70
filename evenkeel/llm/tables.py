"""Small helpers that the operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.sources.staging import BROADCAST_BYTES, ROW_OVERHEAD

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, in batches that fit them.

    Texts may be long, so Arrow's default of 10,000 rows a batch, if it stands,
    is lowered. The path is enough where executors see the same path (local mode, images with the
    package, a shared file system); elsewhere submit it with --py-files.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, quality int, toxic int").parquet(f"{sf_dir}/labels.parquet")


def in_fold(doc_id: str, parts: int, fold: int) -> Column:
    """True where crc32 of the id, as text, leaves `fold`; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == fold, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """`limit` rows at most, by a hash of the key: the same ones on every run.

    For the fit of a model alone; the rows that compete are narrow.
    """
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(7)), key).limit(limit)


def bounded(keys: DataFrame) -> DataFrame:
    """A written table of narrow keys, to be broadcast if it is small: texts joined with it then stay where they are."""
    return F.broadcast(keys) if keys.count() * (2 * ROW_OVERHEAD) <= BROADCAST_BYTES else keys


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], per_part: int = 4_096) -> DataFrame:
    """`rows`, a written table of narrow rows, left joined with `facts`, a row per key, which may be wide.

    Keys with many rows get a salt for each `per_part` of them, and as many
    copies of their facts, so that no task gathers a popular key. Null keys are
    not joined with each other.
    """
    name = F.xxhash64(*keys)
    counts = rows.groupBy(name.alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    # A number per `per_part` rows at most.
    large = F.broadcast(counts.filter(F.col("_n") > per_part).select(
        "_name", F.ceil(F.col("_n") / per_part).cast("int").alias("_salts")))

    def sized(side: DataFrame) -> DataFrame:
        return side.withColumn("_name", name).join(large, "_name", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    salt = F.pmod(F.xxhash64(*[F.col(c) for c, kind in rows.dtypes if not kind.startswith("map")]), F.col("_salts"))
    left = sized(rows).withColumn("_salt", salt.cast("int")).drop("_name", "_salts")
    right = sized(facts).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_name", "_salts")
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of documents with a score from 0 to 1."""
    return docs.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str,
                  limit: int) -> DataFrame:
    """(doc_id, text, label) of at most `limit` labelled documents: a bounded side, broadcast."""
    chosen = bounded_sample(labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
                            .select("doc_id", F.col(label).alias("label")), "doc_id", limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
