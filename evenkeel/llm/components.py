"""Connected components of a graph in Spark: joins and partial aggregates only.

Each round links the neighbours of a node with the smallest of them (large
star), then the smaller neighbours with the smallest (small star), until every
node hangs on the smallest of its component. Rounds grow with the logarithm of
the longest path. Every round is written to the shared folder, which cuts the
lineage; no list of a node's neighbours is ever gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.staging import delete, new_path

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `edges`; component is its smallest node.

    Runs jobs when called. Edges may repeat, in either direction; an edge with
    a null end is ignored. No edges give no rows, nor does a node whose only
    edges lead to itself.
    """
    spark = edges.sparkSession
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull())
    links, path = _write(pair.filter("u != v").distinct())
    before = _mark(links)
    for _ in range(MAX_ROUNDS):
        large, large_path = _large_star(links)
        delete(spark, path)
        links, path = _small_star(large)
        delete(spark, large_path)
        now = _mark(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    own = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def _least(links: DataFrame) -> tuple[DataFrame, str]:
    """Smallest neighbour of each node that has a smaller one.

    Written, so that the join that follows shuffles both sides itself and
    Spark can split a node with very many neighbours.
    """
    return _write(links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x"))


def _large_star(links: DataFrame) -> tuple[DataFrame, str]:
    """Each larger neighbour of a node, linked with the smallest of node and neighbours."""
    least, path = _least(links)
    found = links.join(least, F.col("v") == F.col("x"), "left")
    out = _write(found.select("u", F.coalesce("m", "v").alias("v")).distinct())
    delete(links.sparkSession, path)
    return out


def _small_star(links: DataFrame) -> tuple[DataFrame, str]:
    """The smaller neighbours of a node and itself, linked with the smallest of them."""
    least, path = _least(links)
    rows = links.join(least, F.col("u") == F.col("x"))
    ends = F.explode(F.array("u", "v"))
    out = _write(rows.select(ends.alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
    delete(links.sparkSession, path)
    return out


def _write(rows: DataFrame) -> tuple[DataFrame, str]:
    path = new_path(rows.sparkSession, "links")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _mark(links: DataFrame) -> tuple:
    """Count and sum of the links: tell whether a round changed anything."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark)).first())
