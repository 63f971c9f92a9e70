"""Crawl bookkeeping: the plan before a crawl, the outcome after it.

Attempt log: `run`, `ts`, `url`, `attempt` (1, or 2 for the one deferred
retry), `kind` (`saved`, `failed`, or `responded` for a response that was not
written), `status`, `bytes`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions import links as L
from evenkeel.functions import patterns as P
from evenkeel.functions.order import digest_bucket, seeded_order
from evenkeel.operators.keys import require_clean_audit, require_reproduced_keys
from evenkeel.operators.membership import KeyFilter, key_filter, with_maybe
from evenkeel.operators.ranking import RANK_DIGITS, first_positions, queue_positions
from evenkeel.sources.staging import staged

RETRY_BATCH_SIZE = 10_000
PROGRESS_EVERY = 100
STATES = ("run string, url string, saved boolean, failed_once boolean, failed_twice boolean, "
          "retried boolean, first_failure timestamp, attempts int")


def crawl_plan(links: DataFrame, listing: DataFrame, failed: DataFrame,
               limit: int | None = None, seed: int = 0,
               audit: DataFrame | None = None, check_keys: bool = True,
               known: KeyFilter | None = None) -> DataFrame:
    """Class of each link: `cached`, `known_failed`, `pending` or `backlog`.

    `links` has distinct (link, link_hash), `listing` the `file_name` of every
    file in the cache, `failed` the `url` of permanent failures. `limit` is the
    wanted size of the cache: all its files count against it, with or without
    a link. The first links in seeded order (`crawl_order`) are pending.

    A key that its link does not give stops the plan: it would name files that
    no later run finds. `check_keys` turns this guard off; an `audit` of keys
    that are stored elsewhere adds another. `known` is a filter over the keys of
    all cached and failed links (`known_keys`): links that are surely in neither
    are then classed where they are read, and only the others are joined.

    Jobs run when called: the guard, and with a limit the classes, which are
    written once, and the budget, which is cut from counted buckets.
    """
    if check_keys:
        require_reproduced_keys(links)
    if audit is not None:
        require_clean_audit(audit)
    cached = _cached_keys(listing).distinct().withColumn("_cached", F.lit(True))
    # By link hash as well: both joins share the links' partitioning.
    dead = _failed_keys(failed).distinct().withColumn("_failed", F.lit(True))
    asked, fresh = links.select("link", "link_hash"), None
    if known is not None:
        marked = with_maybe(asked, known, "link_hash", "_maybe")
        asked = marked.filter("_maybe").drop("_maybe")
        fresh = marked.filter("not _maybe").select("link", "link_hash", F.lit("pending").alias("status"))
    status = (F.when(F.col("_cached"), "cached").when(F.col("_failed"), "known_failed")
              .otherwise("pending"))
    met = asked.join(cached, "link_hash", "left").join(dead, "link_hash", "left")
    classed = met.select("link", "link_hash", status.alias("status"))
    if fresh is not None:
        classed = classed.unionByName(fresh)
    if limit is not None:
        classed = staged(classed, "crawl-plan")
    plan = classed.select("link", "link_hash", L.fetch_url(F.col("link")).alias("url"),
                          seeded_order(F.col("link"), seed).alias("crawl_order"), "status")
    if limit is None:
        return plan
    budget = max(limit - listing.count(), 0)
    last = _last_of_budget(plan.filter(F.col("status") == "pending").select("crawl_order"), budget)
    over = (F.col("status") == "pending") & (F.col("crawl_order") > last)
    return plan.withColumn("status", F.when(over, "backlog").otherwise(F.col("status")))


def _cached_keys(listing: DataFrame) -> DataFrame:
    return listing.select(L.file_stem(F.col("file_name")).alias("link_hash"))


def _failed_keys(failed: DataFrame) -> DataFrame:
    logged = F.substring(F.col("url"), len(P.FETCH_SCHEME) + 1, 2**31 - 1)
    return failed.filter(F.col("url").startswith(P.FETCH_SCHEME)).select(L.link_hash(logged).alias("link_hash"))


def known_keys(listing: DataFrame, failed: DataFrame) -> KeyFilter:
    """A filter over the keys of all cached and failed links, for `crawl_plan`. Runs jobs when called."""
    return key_filter(_cached_keys(listing).unionByName(_failed_keys(failed)))


def _last_of_budget(pending: DataFrame, budget: int) -> str:
    """Digest of the last link within the budget, from counted digest buckets."""
    if budget == 0:
        return ""
    bucket = digest_bucket(F.col("crawl_order"), RANK_DIGITS)
    counts = pending.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    # 65,536 counts at most.
    upto = F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    reached = (counts.withColumn("upto", upto)
               .filter((F.col("upto") >= budget) & (F.col("upto") - F.col("rows") < budget)).first())
    if reached is None:
        return "~"  # sorts behind every digest: all links are within the budget
    need = budget - (reached["upto"] - reached["rows"])
    # Links are distinct, so a bucket holds about 1/65536 of them.
    return (pending.filter(bucket == reached["bucket"]).orderBy("crawl_order").limit(need)
            .agg(F.max("crawl_order").alias("last")).first()["last"])


def crawl_plan_report(plan: DataFrame, listing: DataFrame) -> DataFrame:
    """Sizes of a plan, one row; `already_cached` counts files, not links."""
    files = listing.agg(F.count(F.lit(1)).alias("n")).scalar()

    def links(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status)

    counts = plan.agg(F.count(F.lit(1)).alias("links"), links("cached"), links("known_failed"),
                      links("pending"), links("backlog"))
    return counts.withColumn("already_cached", files)


def first_two_attempts(log: DataFrame, slot: list[str], order: list[str]) -> DataFrame:
    """Number the records of a log that has no attempt numbers.

    A URL is tried once more, and only after a failure; other records of a
    slot are no attempts. Only two records per slot and task are shuffled.
    """
    by_slot = Window.partitionBy(*slot).orderBy(*order)
    first_two = log.withColumn("attempt", F.row_number().over(by_slot)).filter(F.col("attempt") <= 2)
    earlier = F.lag("kind").over(by_slot)
    return (first_two.withColumn("_earlier", earlier)
            .filter((F.col("attempt") == 1) | (F.col("_earlier") == "failed")).drop("_earlier"))


def number_tries(log: DataFrame, slot: list[str], order: list[str]) -> DataFrame:
    """Add `try` (from 1) and `attempt` (1 or 2) to a log that has neither.

    A failure is tried once more by the next record of its slot; any other
    record closes its try, and the next one opens another. No record is left
    out. A window holds the records of one slot.
    """
    by_slot = Window.partitionBy(*slot).orderBy(*order)
    closed = F.sum((F.col("kind") != "failed").cast("int")).over(
        by_slot.rowsBetween(Window.unboundedPreceding, -1))
    grouped = log.withColumn("_closed", F.coalesce(closed, F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*slot, "_closed").orderBy(*order))
    numbered = grouped.withColumn("attempt", (place - 1) % 2 + 1)
    opened = F.sum((F.col("attempt") == 1).cast("int")).over(by_slot.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("try", opened).drop("_closed")


def outcome_states(log: DataFrame) -> DataFrame:
    """What a log, or a part of one, tells of each URL: minima and maxima that can be merged.

    Conditional aggregates over fixed-width values: combined map-side, and
    a record that is logged twice changes nothing.
    """
    failed = F.col("kind") == "failed"
    first, second = F.col("attempt") == 1, F.col("attempt") == 2
    return log.groupBy("run", "url").agg(
        F.max(F.col("kind") == "saved").alias("saved"),
        F.max(first & failed).alias("failed_once"),
        F.max(second & failed).alias("failed_twice"),
        F.max(second).alias("retried"),
        F.min(F.when(first & failed, F.col("ts"))).alias("first_failure"),
        F.max("attempt").cast("int").alias("attempts"))


def merge_states(states: DataFrame) -> DataFrame:
    """States of parts of a log as the state of the whole."""
    most = [F.max(c).alias(c) for c in ("saved", "failed_once", "failed_twice", "retried")]
    return states.groupBy("run", "url").agg(*most, F.min("first_failure").alias("first_failure"),
                                            F.max("attempts").alias("attempts"))


def outcomes_of(states: DataFrame) -> DataFrame:
    outcome = (F.when(F.col("saved"), "saved")
               .when(F.col("failed_twice"), "failed_permanently")
               .when(F.col("failed_once") & ~F.col("retried"), "retry_pending")
               .otherwise("responded_not_saved"))
    return states.select("run", "url", "attempts", "first_failure", outcome.alias("outcome"))


def crawl_outcome(log: DataFrame) -> DataFrame:
    """Outcome per URL: `saved`, `failed_permanently`, `retry_pending` or `responded_not_saved`."""
    return outcomes_of(outcome_states(log))


def retry_batches(outcomes: DataFrame, size: int = RETRY_BATCH_SIZE, seed: int = 0) -> DataFrame:
    """`retry_batch` (from 0) of the URLs that wait for their retry, first failed first.

    URLs that failed at one instant follow in seeded order. Runs a job when called.
    """
    waiting = outcomes.filter(F.col("outcome") == "retry_pending")
    placed = queue_positions(waiting, "first_failure", "url", seed)
    return placed.withColumn("retry_batch", F.floor((F.col("position") - 1) / size)).drop("position")


def failure_times(log: DataFrame) -> DataFrame:
    """(run, url, failed_at) of the URLs whose retry failed, at that moment."""
    twice = (F.col("kind") == "failed") & (F.col("attempt") == 2)
    return log.filter(twice).groupBy("run", "url").agg(F.min("ts").alias("failed_at"))


def backlog_draws(failures: DataFrame, backlog: DataFrame, seed: int = 0) -> DataFrame:
    """Which backlog link replaces each permanent failure: (run, url, failed_at, position, replacement).

    `failures` has (run, url, failed_at), `backlog` (run, url, crawl_order), a
    link once in a run. The k-th failure of a run, in the order in which they
    happened (at one moment in seeded order), draws the k-th link of the run's
    backlog in crawl order. A failure behind the backlog's end is a dead end:
    its `replacement` is null. Both sides are numbered by counted buckets, so a
    run may hold any share of all rows, and only as much of the backlog is
    moved as is drawn. Rows without run are left out. Runs jobs when called.
    """
    known = failures.filter(F.col("run").isNotNull()).select("run", "url", "failed_at")
    placed = staged(queue_positions(known, "failed_at", "url", seed, "run"), "failures")
    wanted = placed.groupBy("run").agg(F.max("position").alias("wanted"))
    drawn = first_positions(backlog.select("run", "url", "crawl_order"), "crawl_order", "url", "run", wanted)
    return placed.join(drawn.select("run", "position", F.col("url").alias("replacement")), ["run", "position"], "left")


def progress_marks(log: DataFrame, sizes: DataFrame, every: int = PROGRESS_EVERY, seed: int = 0) -> DataFrame:
    """A row at each `every`-th saved page of a run: (run, url, ts, saved, remaining).

    `sizes` has (run, pending, backlog). Pages count in the order in which they
    were saved, at one moment in seeded order. A saved page leaves one link less
    to visit, and so does a permanent failure behind the backlog's end. Numbered
    by counted buckets, as a run may be the whole log. Rows without run are left
    out. Runs jobs when called.
    """
    saved = F.col("kind") == "saved"
    ends = log.filter(F.col("run").isNotNull() & (saved | ((F.col("kind") == "failed") & (F.col("attempt") == 2))))
    placed = queue_positions(ends.select("run", "url", "ts", "kind"), "ts", "url", seed, "run")
    pages = placed.filter(saved).withColumnRenamed("position", "_ended")
    marks = queue_positions(pages, "ts", "url", seed, "run").filter(F.col("position") % every == 0)
    failed = F.col("_ended") - F.col("position")
    remaining = F.col("pending") - F.col("position") - F.greatest(failed - F.col("backlog"), F.lit(0))
    return marks.join(sizes, "run").select("run", "url", "ts", F.col("position").alias("saved"),
                                           remaining.alias("remaining"))


def permanent_failures(outcomes: DataFrame) -> DataFrame:
    """URLs for the failed log, which later plans skip."""
    return outcomes.filter(F.col("outcome") == "failed_permanently").select("url")
