"""Not-modified revisits of web captures, resolved by an as-of join.

A revisit record stands for a page that the server called unchanged. It is
joined with the latest earlier full response of its canonical URL; validators
are compared and the permitted headers merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm import tables
from evenkeel.operators.membership import key_filter, with_maybe
from evenkeel.sources.staging import discard, staged

# Seconds of a bucket: within one, the seconds of a URL are ordered by a task; buckets meet by their last response.
BUCKET = 86_400
# Headers that describe the stored body or one connection, which a revisit may not change.
STORED_ONLY = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
               "keep-alive", "proxy-connection", "set-cookie", "te", "trailer", "transfer-encoding", "upgrade")
# Parameters that do not change a page.
TRACKING = r"^(?:utm_[a-z]+|gclid|fbclid|msclkid|ref)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, `www.` and default port; path without last slash; sorted parameters."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www[0-9]*\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    parameters = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(parameters, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                    .otherwise(F.lit("")))


def headers(column: Column) -> Column:
    """Header names in lower case; of names that repeat the last value counts. Null is no header."""
    names = F.transform(F.map_keys(column), F.lower)
    entries = F.transform(F.map_entries(column), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    # Names that repeat are rare: only they are looked for among those that follow.
    lowered = (F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, F.map_values(column)))
               .otherwise(F.map_from_entries(last)))
    return F.coalesce(lowered, F.create_map().cast("map<string,string>"))


def opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), r'^W/|"', "")


def resolve(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """A row per revisit, with the response it stands for.

    `records` has record_id, url, ts (seconds), kind (`response` or `revisit`),
    headers (map) and payload; other columns are not used, nor other kinds.
    Result: record_id, ts, url_key, response_id, outcome, headers, payload.

    The response is the latest with an earlier ts, the highest record_id among
    equals. Outcomes: `no_response`; `mismatch` if the entity tags, or else the
    modification times, are both given and differ; `resolved` if they agree;
    `unchecked` if no validator is given by both. Headers and payload are null
    unless resolved or unchecked. A null url or ts finds no response. Revisits
    that repeat a record_id stay, each with its own headers; a response whose
    record_id repeats is taken once. No records give no rows.

    What is ordered is a row per URL and second, so a popular page adds no more
    than the seconds of a day to a task. Outcomes are told by headers alone; of
    the bodies only those that a revisit gets are moved, once, and a popular one
    is copied for each few thousand of its revisits. Runs jobs when called.
    """
    keyed = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", F.col("ts").cast("bigint").alias("ts"), "headers", "payload",
        canonical_url(F.col("url")).alias("url_key"))
    # Of responses that repeat a record_id the one with the least digest counts.
    digest = F.xxhash64(F.map_entries("headers"), "payload")
    # Records are made, and their URLs and bodies read, once for all that follows but the bodies.
    narrow = staged(keyed.select("record_id", "kind", "ts", "url_key", "headers",
                                 F.when(F.col("kind") == "response", digest).alias("_digest")), "records")
    asked = narrow.filter("kind = 'revisit'").select("record_id", "ts", "url_key", F.col("headers").alias("asked"))
    met = staged(tables.spread_join(asked, _found(narrow, bucket), ["url_key", "ts"]), "met-revisits")
    heads = staged(narrow.filter("kind = 'response'").groupBy(F.col("record_id").alias("response_id")).agg(
        F.min_by("headers", "_digest").alias("stored"), F.min("_digest").alias("_digest"),
        F.count(F.lit(1)).alias("_rows")), "response-headers")
    bodies = keyed.filter("kind = 'response'").select(F.col("record_id").alias("response_id"), "payload", digest.alias("_digest"))
    # Revisits without response do not meet each other in the join.
    alone = met.filter("response_id is null").select("*", F.lit(None).cast("map<string,string>").alias("stored"),
                                                     F.lit(None).cast("bigint").alias("_digest"))
    joined = tables.spread_join(met.filter("response_id is not null"), heads.drop("_rows"), ["response_id"])
    told = staged(_told(joined.unionByName(alone)), "told-revisits")
    full = told.filter(F.col("outcome").isin("resolved", "unchecked"))
    wanted = key_filter(full, "response_id")
    needed = with_maybe(bodies, wanted, "response_id", "_maybe").filter("_maybe").select("response_id", "_digest", "payload")
    if not heads.filter("_rows > 1").isEmpty():
        needed = needed.dropDuplicates(["response_id", "_digest"])
    # What was told holds all that is needed of them; the bodies find their room free.
    for table in (narrow, met, heads):
        discard(table)
    with_body = tables.spread_join(full, needed, ["response_id", "_digest"])
    rest = told.filter(~F.col("outcome").isin("resolved", "unchecked")).withColumn("payload", F.lit(None).cast("string"))
    return with_body.unionByName(rest).select("record_id", "ts", "url_key", "response_id", "outcome", "headers", "payload")


def _told(joined: DataFrame) -> DataFrame:
    """Outcome and merged headers of revisits with the headers that were asked and stored."""
    joined = joined.withColumns({"asked": headers(F.col("asked")), "stored": headers(F.col("stored"))})
    tag = opaque(F.col("asked")["etag"]), opaque(F.col("stored")["etag"])
    time = F.col("asked")["last-modified"], F.col("stored")["last-modified"]
    # Columns of their own, so that they are computed once a row.
    joined = joined.withColumns({"agree": F.coalesce(tag[0] == tag[1], time[0] == time[1]),
                                 "new": F.map_filter("asked", lambda k, _: ~k.isin(*STORED_ONLY))})
    joined = joined.withColumn("names", F.map_keys("new"))
    agree = F.col("agree")
    outcome = (F.when(F.col("response_id").isNull(), "no_response").when(agree.isNull(), "unchecked")
               .when(agree, "resolved").otherwise("mismatch"))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.array_contains("names", k)), "new")
    full = F.col("outcome").isin("resolved", "unchecked")
    return joined.withColumn("outcome", outcome).select(
        "record_id", "ts", "url_key", "response_id", "_digest", "outcome", F.when(full, merged).alias("headers"))


def _found(keyed: DataFrame, bucket: int) -> DataFrame:
    """(url_key, ts, response_id) for each URL and second with a revisit: the last earlier response, if there is one."""
    # Numbers and flags alone, so that nothing is sorted to be counted.
    answered = F.col("kind") == "response"
    seconds = keyed.filter(F.col("ts").isNotNull() & F.col("url_key").isNotNull()).groupBy("url_key", "ts").agg(
        F.max(answered).alias("answered"), F.max(F.when(answered, F.col("record_id"))).alias("record_id"),
        F.max(F.col("kind") == "revisit").alias("asked"))
    placed = seconds.withColumns({"bucket": F.floor(F.col("ts") / bucket),
                                  "own": F.when(F.col("answered"), F.struct("ts", "record_id"))})
    # One row per URL and bucket carries the last response of the buckets before.
    last = F.when(F.col("answered"), F.col("ts"))
    lasts = placed.groupBy("url_key", "bucket").agg(F.max(last).alias("ts"), F.max_by("record_id", last).alias("record_id"))
    lasts = lasts.select("url_key", "bucket", F.when(F.col("ts").isNotNull(), F.struct("ts", "record_id")).alias("last"))
    earlier = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("url_key", "bucket", F.max("last").over(earlier).alias("carried"))
    # A response of the revisit's own second is not earlier.
    inside = Window.partitionBy("url_key", "bucket").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("inner", F.max("own").over(inside)).filter("asked")
    return ordered.join(carried, ["url_key", "bucket"], "left").select(
        "url_key", "ts", F.coalesce("inner", "carried")["record_id"].alias("response_id"))
