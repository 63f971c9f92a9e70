"""Tables laid out by key, so that joins on it move nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 256


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "link_hash", buckets: int = BUCKETS) -> None:
    """Write `df` as a table of `buckets` buckets of `key`, sorted inside.

    Rows are first brought together by bucket, so that a bucket is one file.
    Two tables join without an exchange if key and number of buckets agree.
    A bucket should fit a task; a null key has a bucket too.
    """
    (df.repartition(buckets, key).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def open_bucketed(spark: SparkSession, table: str, path: str, schema: str, key: str = "link_hash",
                  buckets: int = BUCKETS) -> DataFrame:
    """The table in a session whose catalogue does not know it yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
