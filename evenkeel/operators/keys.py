"""Key audit and migration of page keys from the legacy file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions import links as L
from evenkeel.sources.staging import staged

CONFLICT_EXAMPLES = 10
RENAME_EXAMPLES = 3


class KeyAuditError(RuntimeError):
    """Stored keys are not reproduced, or a migration would lose data."""


def key_audit(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Each stored link as `ok`, `missing` from the source, or `mismatched`."""
    source = recomputed.select("link", F.col("link_hash").alias("link_hash_recomputed"))
    joined = stored.select("link", "link_hash").dropDuplicates(["link", "link_hash"]).join(
        source, "link", "left")
    verdict = (F.when(F.col("link_hash_recomputed").isNull(), "missing")
               .when(F.col("link_hash") != F.col("link_hash_recomputed"), "mismatched")
               .otherwise("ok"))
    return joined.withColumn("verdict", verdict)


def require_clean_audit(audit: DataFrame) -> None:
    """Abort on any bad key, with counts and one example."""
    bad = audit.filter(F.col("verdict") != "ok")
    counts = {r["verdict"]: r["count"] for r in bad.groupBy("verdict").count().collect()}
    if counts:
        example = bad.orderBy("link").first()
        raise KeyAuditError(f"stored keys are not reproduced: {counts}, e.g. {example['link']!r}: "
                            f"stored {example['link_hash']}, "
                            f"recomputed {example['link_hash_recomputed']}")


def require_reproduced_keys(links: DataFrame) -> None:
    """Abort unless each `link_hash` is what its `link` gives: one pass, one row to the driver."""
    again = L.link_hash(F.col("link"))
    bad = links.filter(F.col("link_hash").isNull() | (F.col("link_hash") != again)).filter(F.col("link").isNotNull())
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("link", "link_hash", again.alias("again"))).alias("one")
                    ).first()
    if found["n"]:
        one = found["one"]
        raise KeyAuditError(f"{found['n']} stored keys are not reproduced, e.g. {one['link']!r}: "
                            f"stored {one['link_hash']}, recomputed {one['again']}")


def rename_map(links: DataFrame, check_keys: bool = True) -> DataFrame:
    """Legacy file name to new file name, one row per link.

    A key that its link does not give stops it, unless `check_keys` is off:
    pages must not be renamed to names that no later run finds. Runs a job
    when called.
    """
    if check_keys:
        require_reproduced_keys(links)
    return links.select(L.legacy_file(F.col("link")).alias("old_name"),
                        L.page_file(F.col("link_hash")).alias("new_name"))


def key_collisions(mapping: DataFrame) -> DataFrame:
    """Names that break a one-to-one migration, with how many names they meet.

    `old_to_many`: an old name with several new ones. `many_to_new`: a new name
    that several old ones claim. Equal pairs are combined before each shuffle.
    """
    pairs = mapping.select("old_name", "new_name").distinct()

    def repeated(kind: str, name: str) -> DataFrame:
        return (pairs.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1).select(F.lit(kind).alias("kind"), "name", "n"))

    return repeated("old_to_many", "old_name").unionByName(repeated("many_to_new", "new_name"))


def key_migration_plan(listing: DataFrame, mapping: DataFrame,
                       audit: DataFrame | None = None) -> DataFrame:
    """Class of each file: `already_migrated`, `unmatched`, `ambiguous`, `conflict`, `rename`.

    A file that already has a new name stays; a target that exists is never
    overwritten; a file whose old name has several new ones is `ambiguous` and
    gets none. With an `audit` of the stored keys, a bad key stops the plan.
    """
    if audit is not None:
        require_clean_audit(audit)
    files = listing.select("file_name").distinct()
    targets = mapping.select(F.col("new_name").alias("file_name")).distinct().withColumn(
        "_is_new", F.lit(True))
    # The target test is done on the map, where no name is null, so that files
    # that match nothing do not meet in one join partition.
    present = files.select(F.col("file_name").alias("new_name"), F.lit(True).alias("_present"))
    single = mapping.select("old_name", "new_name").distinct().groupBy("old_name").agg(
        F.min("new_name").alias("new_name"), (F.count(F.lit(1)) > 1).alias("_several"))
    sources = (single.join(present, "new_name", "left")
               .withColumnRenamed("old_name", "file_name"))
    known = files.join(targets, "file_name", "left").join(sources, "file_name", "left")
    action = (F.when(F.col("_is_new"), "already_migrated")
              .when(F.col("new_name").isNull(), "unmatched")
              .when(F.col("_several"), "ambiguous")
              .when(F.col("_present"), "conflict")
              .otherwise("rename"))
    target = F.when(action.isin("conflict", "rename"), F.col("new_name"))
    return known.select("file_name", target.alias("new_name"), action.alias("action"))


def key_migration_report(plan: DataFrame) -> DataFrame:
    """Files per action, one row."""
    def files(action: str) -> Column:
        return F.count_if(F.col("action") == action).alias(action)

    return plan.agg(F.count(F.lit(1)).alias("files"), files("rename"), files("already_migrated"),
                    files("conflict"), files("unmatched"), files("ambiguous"))


def key_migration_examples(plan: DataFrame) -> DataFrame:
    """First conflicts and renames for the report, from one pass over the plan.

    Each task passes on its first few rows only.
    """
    wanted = F.when(F.col("action") == "conflict", CONFLICT_EXAMPLES).when(
        F.col("action") == "rename", RENAME_EXAMPLES)
    place = F.row_number().over(Window.partitionBy("action").orderBy("file_name"))
    return (plan.filter(F.col("action").isin("conflict", "rename")).withColumn("_place", place)
            .filter(F.col("_place") <= max(CONFLICT_EXAMPLES, RENAME_EXAMPLES))
            .filter(F.col("_place") <= wanted).drop("_place"))


def migrate_keys(pages: DataFrame, plan: DataFrame) -> DataFrame:
    """Page table with new keys: the applied plan. Only `rename` rows change.

    Two files that would get one target stop the migration, as does a file
    with several targets. Runs a job when called.
    """
    several = plan.filter(F.col("action") == "ambiguous").select("file_name").first()
    if several is not None:
        raise KeyAuditError(f"an old name has several new ones: {several['file_name']}")
    renames = staged(plan.filter(F.col("action") == "rename"), "renames")
    clashes = renames.groupBy("new_name").count().filter(F.col("count") > 1)
    if not clashes.isEmpty():
        raise KeyAuditError("two files map to the same target name")
    moved = renames.select(L.file_stem(F.col("file_name")).alias("link_hash"),
                           L.file_stem(F.col("new_name")).alias("_new"))
    return (pages.join(moved, "link_hash", "left")
            .withColumn("link_hash", F.coalesce("_new", "link_hash")).drop("_new"))
