"""Small intermediate tables, written once to the cluster's shared folder.

Used for aggregates that several jobs need: the written table cuts the
lineage, survives the loss of executors and has a known size.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Key tables up to this many bytes of row data may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Fixed cost counted per row next to its key: numbers, digests and headers.
ROW_OVERHEAD = 128
# Temporary folders of local sessions, by application.
_LOCAL: dict[str, str | None] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`, else the context's own.

    Only a local session (tests) may do without either; it then gets one
    temporary folder per application. The session's settings stay as they are.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _LOCAL.setdefault(context.applicationId, None) or tempfile.mkdtemp(prefix="evenkeel-")
        _LOCAL[context.applicationId] = folder
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder of this application, which may go when it has ended."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/evenkeel/{app}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a staged folder through the file system that holds it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Remove all that this application has staged; call it once its results are written."""
    delete(spark, f"{shared_dir(spark)}/evenkeel/{spark.sparkContext.applicationId}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table that `staged` wrote, once nothing reads it any more."""
    for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
        delete(table.sparkSession, path)


def staged_with_facts(df: DataFrame, label: str, *facts: Column) -> tuple[DataFrame, dict]:
    """`staged`, with aggregates that are taken while the table is written.

    A stage that is run again may count rows twice: use counts and sums as
    upper bounds only; minima and maxima are exact.
    """
    seen = Observation()
    return staged(df.observe(seen, *facts), label), seen.get


def key_bytes(key: str) -> Column:
    """Aggregate: upper estimate of the memory for a table with one row per key."""
    size = F.octet_length(F.col(key).cast("string"))
    return F.coalesce(F.sum(size), F.lit(0)) + ROW_OVERHEAD * F.count(F.lit(1))
