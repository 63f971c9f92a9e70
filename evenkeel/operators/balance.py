"""Website distribution, hold-out split and removal of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.staging import BROADCAST_BYTES, ROW_OVERHEAD, key_bytes, staged_with_facts

EVAL_WEBSITES = 16
# A website's rows are spread over portions of about this size when its count is joined on.
ROWS_PER_SALT = 1_000_000


def website_counts(df: DataFrame, group: str = "website") -> DataFrame:
    """Rows per website, column `n`; rows without website are a group too."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def website_distribution(df: DataFrame, group: str = "website") -> DataFrame:
    """Rows per website and their share of all rows, column `frequency`."""
    counts = website_counts(df, group)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("frequency", F.col("n") / total)


def smallest_websites(counts: DataFrame, k: int = EVAL_WEBSITES,
                      group: str = "website") -> DataFrame:
    """The `k` least frequent websites, ties by name: a top-k, no full sort."""
    return counts.filter(F.col(group).isNotNull()).orderBy("n", group).limit(k)


def flag_eval(df: DataFrame, k: int = EVAL_WEBSITES, group: str = "website") -> DataFrame:
    """Add `eval`: true on rows of the `k` least frequent websites."""
    held_out = smallest_websites(website_counts(df, group), k, group)
    # Broadcast of k rows at most.
    flag = F.broadcast(held_out.select(group, F.lit(True).alias("eval")))
    return df.join(flag, group, "left").withColumn("eval", F.coalesce("eval", F.lit(False)))


def compute_dataset_split(df: DataFrame, k: int = EVAL_WEBSITES,
                          group: str = "website") -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows; no website is in both.

    Rows without website belong to neither, see `rejected_rows`.
    """
    flagged = flag_eval(df.filter(F.col(group).isNotNull()), k, group)
    return (flagged.filter(~F.col("eval")).drop("eval"), flagged.filter("eval").drop("eval"))


def rejected_rows(df: DataFrame, group: str = "website") -> DataFrame:
    return df.filter(F.col(group).isNull())


def with_website_counts(df: DataFrame, key: str, group: str = "website",
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join with the website counts, column `n`.

    The counts are broadcast if they are small. Otherwise both sides get a salt,
    as many as a website's rows ask for, so that a dominant website is joined
    by many tasks. Runs a job when called.
    """
    known = df.filter(F.col(group).isNotNull())
    counts, sizes = staged_with_facts(website_counts(known, group), "counts",
                                      key_bytes(group).alias("bytes"))
    if sizes["bytes"] <= broadcast_bytes:
        return df.join(F.broadcast(counts), group)
    name = F.xxhash64(group).alias("_name")
    # One row of two numbers per ROWS_PER_SALT rows at most.
    large = F.broadcast(counts.filter(F.col("n") > ROWS_PER_SALT).groupBy(name).agg(
        F.max(F.ceil(F.col("n") / ROWS_PER_SALT)).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))

    def sized(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_name", name).join(large, "_name", "left").drop("_name")

    salted = sized(counts).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    spread = sized(df).withColumn("_salt", F.pmod(F.xxhash64(key), salts).cast("int")).drop("_salts")
    return spread.join(salted, [group, "_salt"]).drop("_salt")


def deduplicate(df: DataFrame, key: str = "link", response: str = "response",
                group: str = "website", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per `response`: the one whose website is rarest.

    Ties go by website, key and a digest of the other columns. Rows without
    website take no part; null responses are copies of each other. Copies are
    settled on digests and keys alone: those of repeated responses are written,
    and the rows that lose are left out where they are read, so a text is
    neither sorted nor aggregated. Only rows that are repeated whole are brought
    together. Runs jobs when called.
    """
    marked = _marked(df, key, response, group, broadcast_bytes)
    repeated, facts = staged_with_facts(
        repeated_responses(marked, key, group), "repeated-responses", F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("copies"))
    if facts["rows"] * 2 * ROW_OVERHEAD <= broadcast_bytes:
        repeated = F.broadcast(repeated)
    met = marked.join(repeated, "_same", "left")
    first = (F.col("n") == F.col("first.n")) & (F.col(group) == F.col(f"first.{group}")) & F.col(key).eqNullSafe(
        F.col(f"first.{key}")) & (F.col("_rest") == F.col("first._rest"))
    kept = met.filter(F.col("first").isNull() | first)
    once = kept.filter(F.coalesce("copies", F.lit(1)) == 1).select(*df.columns)
    if facts["copies"] <= 1:
        return once
    return once.unionByName(kept.filter("copies > 1").dropDuplicates(["_same"]).select(*df.columns))


def repeated_responses(marked: DataFrame, key: str, group: str) -> DataFrame:
    """(_same, first, copies): the first of each repeated response, and how many rows are just like it."""
    same = marked.select("_same", F.struct("n", group, key, "_rest").alias("row"))
    rows = same.groupBy("_same", "row").agg(F.count(F.lit(1)).alias("copies"))
    found = rows.groupBy("_same").agg(F.min(F.struct("row", "copies")).alias("first"), F.sum("copies").alias("rows"))
    return found.filter("rows > 1").select("_same", F.col("first.row").alias("first"), F.col("first.copies").alias("copies"))


def _marked(df: DataFrame, key: str, response: str, group: str, broadcast_bytes: int) -> DataFrame:
    """Rows with the website's count, a digest of the response and one of the columns beside the keys."""
    counted = with_website_counts(df, key, group, broadcast_bytes)
    rest = [c for c in df.columns if c not in (group, key)]
    same = F.coalesce(F.sha2(F.col(response), 256), F.lit(""))
    return counted.withColumn("_same", same).withColumn("_rest", F.xxhash64(*rest))


def split_report(before: DataFrame, after: DataFrame, train: Column | None = None) -> DataFrame:
    """Sizes of the split after balancing and the rows lost by it, one row."""
    train = F.col("train") if train is None else train
    rows_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = after.agg(F.count_if(train).alias("train_rows"), F.count_if(~train).alias("eval_rows"))
    return counts.select(
        "train_rows", "eval_rows",
        (F.col("eval_rows") / F.nullif(F.col("train_rows"), F.lit(0))).alias("eval_to_train"),
        rows_before.alias("rows_before"),
        (F.col("train_rows") + F.col("eval_rows")).alias("rows_after"),
        (rows_before - F.col("train_rows") - F.col("eval_rows")).alias("rows_lost"))
