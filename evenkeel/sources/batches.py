"""Tables that grow by a folder per batch, and the merge of their old folders.

`<root>/batch=<n>` is what batch n wrote; a batch that is run again overwrites
its folder. Merging is log-structured: `FAN` folders of a level become one of the
next, so a row is written again once a level, and a reader meets few folders.
`<root>/_live/<version>.json` names the merged folders and the last batch in
them; the newest version counts. It appears whole, after the folders it names,
and the folders that it replaces stay until `vacuum`. So a reader always finds
each batch once, before, during and after a merge.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from evenkeel.sources import files
from evenkeel.sources.staging import delete

# Folders of a level that are merged into one of the next.
FAN = 8
BATCH, MERGED, LIVE = "batch=", "merged-", "_live"


@dataclass(frozen=True)
class Live:
    """Version, last merged batch, merged folders (level, first batch, last batch, name) and batches behind them."""

    version: int
    through: int
    merged: tuple[tuple[int, int, int, str], ...]
    batches: tuple[int, ...]

    def folders(self) -> list[str]:
        return [name for *_, name in self.merged] + [f"{BATCH}{n}" for n in self.batches]


def live(spark: SparkSession, root: str) -> Live:
    """What is live now; a batch without a success mark is still being written and is left out."""
    versions = [int(n.removesuffix(".json")) for n in files.names(spark, f"{root}/{LIVE}") if n.endswith(".json")]
    version = max(versions, default=0)
    known = json.loads(files.read_text(spark, _manifest(root, version))) if version else {"through": -1, "merged": []}
    numbers = sorted(int(n.removeprefix(BATCH)) for n in files.names(spark, root) if n.startswith(BATCH))
    batches = tuple(n for n in numbers if n > known["through"] and files.exists(spark, f"{root}/{BATCH}{n}/_SUCCESS"))
    return Live(version, known["through"], tuple(map(tuple, known["merged"])), batches)


def write_batch(rows: DataFrame, root: str, batch: int, **options) -> None:
    """Write one batch; run again, it overwrites its folder, or does nothing once it is merged."""
    if batch > live(rows.sparkSession, root).through:
        rows.write.mode("overwrite").options(**options).parquet(f"{root}/{BATCH}{batch}")


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """All live rows; an empty table if nothing is written yet."""
    folders = live(spark, root).folders()
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{name}" for name in folders])


def compact(spark: SparkSession, root: str, schema, merge: Callable[[DataFrame], DataFrame] | None = None,
            fan: int = FAN, **options) -> list[str]:
    """Merge full levels; returns the folders that are no longer live.

    `merge` makes the rows of several folders those of one, such as sums of
    sums; it must not matter in which order and how often it is applied.
    A merge that another process has overtaken changes nothing: its folder is
    never named, and `vacuum` takes it.
    """
    now = live(spark, root)
    before = set(now.folders())
    levels: list[tuple[int, int, int, str]] = [*now.merged, *((0, n, n, f"{BATCH}{n}") for n in now.batches)]
    while full := _full_level(levels, fan):
        level, first, last = full[0][0] + 1, full[0][1], full[-1][2]
        name = f"{MERGED}{level}-{first}-{last}-{uuid.uuid4().hex}"
        rows = spark.read.schema(schema).parquet(*[f"{root}/{n}" for *_, n in full])
        (merge(rows) if merge else rows).write.options(**options).parquet(f"{root}/{name}")
        levels = sorted([x for x in levels if x not in full] + [(level, first, last, name)], key=lambda x: x[1])
    merged = [x for x in levels if x[0]]
    if merged == list(now.merged):
        return []
    manifest = {"through": max(x[2] for x in merged), "merged": merged}
    if not files.publish_text(spark, _manifest(root, now.version + 1), json.dumps(manifest)):
        return []
    return sorted(before - {name for *_, name in levels})


def _full_level(levels: list[tuple[int, int, int, str]], fan: int) -> list[tuple[int, int, int, str]]:
    """The first `fan` neighbours of the lowest level that has as many; older levels come first in the order."""
    for level in sorted({x[0] for x in levels}):
        same = [x for x in levels if x[0] == level]
        if len(same) >= fan:
            return same[:fan]
    return []


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders and manifests that are no longer live; call it when no reader still uses them."""
    now = live(spark, root)
    kept = set(now.folders())

    def dead(name: str) -> bool:
        if name.startswith(MERGED):
            return name not in kept and int(name.split("-")[3]) <= now.through
        return name.startswith(BATCH) and int(name.removeprefix(BATCH)) <= now.through

    gone = [name for name in files.names(spark, root) if dead(name)]
    for name in gone:
        delete(spark, f"{root}/{name}")
    for name in files.names(spark, f"{root}/{LIVE}"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < now.version:
            delete(spark, f"{root}/{LIVE}/{name}")
    return gone


def _manifest(root: str, version: int) -> str:
    return f"{root}/{LIVE}/{version:08d}.json"
