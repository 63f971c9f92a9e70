"""Small files and folder listings through the file system that holds them, whichever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _at(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole; False if the name is taken, whose file then stays."""
    system, target = _at(spark, path)
    part = _at(spark, f"{path}.part-{spark.sparkContext.applicationId}")[1]
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if publish(spark, str(part), path):
        return True
    system.delete(part, False)
    return False


def publish(spark: SparkSession, part: str, path: str) -> bool:
    """Move a file that is whole to its name; False if the name is taken, and both files then stay."""
    system, target = _at(spark, path)
    return not system.exists(target) and system.rename(_at(spark, part)[1], target)


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.mkdirs(target)
