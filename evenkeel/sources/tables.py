"""Readers and writers of the pipeline's tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import links as L
from evenkeel.functions import text as X

RECIPE_COLUMNS = ("title", "ingredients", "directions", "link")
# Small row groups bound the memory for pages; a page is wide.
PAGE_GROUP_BYTES = 16 * 1024 * 1024
BATCHES_PER_BLOCK = 1_000

MESSAGE = T.StructType([T.StructField("role", T.StringType()),
                        T.StructField("content", T.StringType())])
TRAINING = T.StructType([T.StructField("link_hash", T.StringType()),
                         T.StructField("link", T.StringType()),
                         T.StructField("website", T.StringType()),
                         T.StructField("response", T.StringType()),
                         T.StructField("train", T.BooleanType()),
                         T.StructField("input", MESSAGE)])
ATTEMPTS = T.StructType([T.StructField("run", T.StringType()),
                         T.StructField("ts", T.TimestampType()),
                         T.StructField("url", T.StringType()),
                         T.StructField("attempt", T.IntegerType()),
                         T.StructField("kind", T.StringType()),
                         T.StructField("status", T.IntegerType()),
                         T.StructField("bytes", T.LongType())])


def read_recipes(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 multiline: bool = True, header: bool = True) -> DataFrame:
    """Source recipes from CSV.

    Without `schema` all columns of the header (or the four that matter, without
    one) are text, and the four are returned with `_corrupt_record`, which has the
    lines that do not fit.
    `multiline` accepts line breaks inside quotes, but then one task reads
    a whole file: split the source into many files, or turn it off when no
    field holds a raw line break.
    """
    reader = (spark.read.option("header", header).option("multiLine", multiline)
              .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
              .option("columnPruning", False))  # a short line shows in whole lines only
    if schema is None:
        names = reader.csv(path).columns if header else RECIPE_COLUMNS
        text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_corrupt_record")])
        return (reader.schema(text).option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
                .select(*RECIPE_COLUMNS, "_corrupt_record"))
    return (reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("enforceSchema", False).csv(path))


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """(link_hash, html) from a folder of `<link_hash>.html` files."""
    # wholetext is an argument: as an option it would be reset by text().
    pages = spark.read.option("pathGlobFilter", "*.html").text(path, wholetext=True)
    return pages.select(L.file_stem(F.col("_metadata.file_name")).alias("link_hash"),
                        F.col("value").alias("html"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """`file_name` of every file in a folder; no content is read."""
    return (spark.read.format("binaryFile").load(path)
            .select(F.col("_metadata.file_name").alias("file_name")))


def page_listing(page_table: DataFrame) -> DataFrame:
    """`file_name` of every page of a page table: the key column alone is read, no folder is listed."""
    return page_table.select(L.page_file(F.col("link_hash")).alias("file_name"))


def read_failed_log(spark: SparkSession, path: str) -> DataFrame:
    """Distinct URLs of the failed log, one per line; empty when there is no log."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "url string")
    return (lines.select(X.strip_blank(F.col("value")).alias("url"))
            .filter(F.col("url") != "").distinct())


def append_failed_log(failures: DataFrame, path: str) -> None:
    """Append URLs to the failed log, one per line."""
    failures.select("url").write.mode("append").text(path)


def write_page_table(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Page table as zstd Parquet in small row groups."""
    (pages.select("link_hash", "html_data").write.mode(mode).option("compression", "zstd")
     .option("parquet.block.size", PAGE_GROUP_BYTES).parquet(path))


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("link_hash string, html_data string").parquet(path)


def write_prepared(dataset: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Prepared set, one folder per split, so that a reader of one skips the other."""
    dataset.write.mode(mode).partitionBy("train").parquet(path)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Prepared set; `train` comes back from the folder names."""
    return spark.read.schema("link string, website string, link_hash string, response string, "
                             "train boolean").parquet(path)


def write_training(training: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (training.write.mode(mode).option("compression", "zstd")
     .option("parquet.block.size", PAGE_GROUP_BYTES).parquet(path))


def read_training(spark: SparkSession, path: str, row_ids: bool = False) -> DataFrame:
    """Training table; `row_ids` adds a `row_id` that names each stored row.

    The id comes from the file and the row's place in it, so it is the same
    whenever a task is run again, and it tells copies of a row apart.
    """
    training = spark.read.schema(TRAINING).parquet(path)
    if not row_ids:
        return training
    place = F.concat_ws(":", "_metadata.file_name", F.col("_metadata.row_index").cast("string"))
    return training.select("*", place.alias("row_id"))


def stream_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(TRAINING).parquet(path)


def write_batches(batches: DataFrame, path: str, per_block: int = BATCHES_PER_BLOCK,
                  mode: str = "errorifexists") -> None:
    """Training batches in their order: folders of consecutive batches, sorted inside."""
    blocks = batches.withColumn("block", F.floor(F.col("batch") / per_block))
    (blocks.repartition("block").sortWithinPartitions("block", "batch", "position")
     .write.mode(mode).option("compression", "zstd").partitionBy("block").parquet(path))


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Metric points (run, tick, step, tag, value), one folder per run."""
    points.write.mode(mode).partitionBy("run").parquet(path)
