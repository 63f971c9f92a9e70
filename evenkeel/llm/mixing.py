"""Mixing sources to target weights: repetition rates from tokens per source.

Every document is taken floor(rate) times, and once more with a probability of
the rate's fraction, by a draw that a hash of its id decides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.tables import WORD
from evenkeel.sources.staging import staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEEDS = 16
# A draw is the first 13 hexadecimal digits of a digest: exact in a double.
DRAW_DIGITS, DRAWS = 13, float(16 ** 13)


@dataclass(frozen=True)
class Mix:
    """`documents`: one row per input row with its copies; `sources`: one row per source."""

    documents: DataFrame
    sources: DataFrame


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: str, seed: Column) -> Column:
    """A number from 0 to 1 that the id and the seed fix."""
    name = F.concat_ws("|", seed.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, DRAW_DIGITS), 16, 10).cast("double") / DRAWS


def mix_sources(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
                share: float = SHARE, most: int = MOST, seeds: int = SEEDS) -> Mix:
    """Repeat the documents of each source until it reaches its target.

    `docs` needs doc_id, text and source; other columns are kept. `weights`
    repeat over the sources in order of code points, the null source last.
    Targets share `share` of all sizes by weight; none goes above `most` times
    its source, and what is left over is shared anew. Added columns: size,
    source_size, target, copies, taken (size times copies).

    Of `seeds` seeds a source uses the one whose draw comes nearest its target.
    Runs jobs when called: sizes are aggregated per source before anything
    moves, and the documents are joined with their source's row, which Spark
    broadcasts or splits by its own measure. Null or empty texts have size 0
    and rate as any other; a source of size 0 has target 0 and rate 0. Rows
    that repeat draw alike. No rows give no rows.
    """
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    sized = docs.select(*kept, (word_count() if size is None else size).alias("size"))
    sources = staged(_ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")), len(weights)),
                     "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    targets = _targets(sources.withColumn("weight", weight), share, most)
    rates = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                               .otherwise(0.0))
    seeded = staged(_seeds(sized.select("doc_id", "source", "size"), rates, seeds), "mix-rates")
    rows = sized.alias("d").join(seeded.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
    copies = _copies(F.col("r.rate"), F.col("r.seed"), "d.doc_id")
    columns = [F.col(f"d.`{c}`") for c in kept]
    out = rows.select(*columns, "d.size", "r.source_size", "r.target", copies.alias("copies"),
                      (F.col("d.size") * copies).alias("taken"))
    return Mix(out, seeded)


def repeat(mixed: DataFrame) -> DataFrame:
    """Each document as many times as it is taken; `copy` counts from 0."""
    numbers = F.sequence(F.lit(0), F.col("copies").cast("int") - 1)
    return mixed.filter("copies > 0").withColumn("copy", F.explode(numbers))


def _copies(rate: Column, seed: Column, doc_id: str = "doc_id") -> Column:
    whole = F.floor(rate)
    return whole + (draw(doc_id, seed) < rate - whole).cast("bigint")


def _ranked(sources: DataFrame, cycle: int) -> DataFrame:
    """Place of each source in order, from 0: sorted by ranges, then offsets of the ranges."""
    ordered = staged(sources.orderBy(F.col("source").asc_nulls_last())
                     .withColumn("_id", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("_id", 33)
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []  # one number per range of the sort
    for row in sorted(counts):
        offsets.append((row["_part"], before))
        before += row["n"]
    table = sources.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (ordered.withColumn("_part", part).join(F.broadcast(table), "_part")
            .select("source", "source_size", (F.col("_before") + inside).alias("rank")))


def _targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """Targets by weight, full sources taken out until none is above its limit."""
    full = F.lit(False)
    level, before = 0.0, -1
    while True:
        over = sources.agg(
            F.sum("source_size").alias("total"), F.count_if(full).alias("n"),
            F.sum(F.when(full, F.col("source_size"))).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if over["n"] == before or not over["weight"]:
            break
        before = over["n"]
        level = (share * (over["total"] or 0) - most * (over["taken"] or 0)) / over["weight"]
        full = F.col("weight") * level >= most * F.col("source_size")
    target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.withColumn("target", target)


def _seeds(sized: DataFrame, rates: DataFrame, seeds: int) -> DataFrame:
    """The seed of each source: least distance from the target, then the lowest."""
    rate = rates.select(F.col("source").alias("_source"), "rate")
    joined = sized.join(rate, F.col("source").eqNullSafe(F.col("_source")))
    taken = [F.sum(F.col("size") * _copies(F.col("rate"), F.lit(s))).alias(f"t{s}") for s in range(seeds)]
    sums = joined.groupBy("_source").agg(*taken)
    ranked = [F.struct(F.abs(F.col(f"t{s}") - F.col("target")).alias("off"), F.lit(s).alias("seed"))
              for s in range(seeds)]
    both = rates.join(sums, F.col("source").eqNullSafe(F.col("_source")))
    return both.withColumn("seed", F.array_min(F.array(*ranked))["seed"]).drop("_source", *[f"t{s}" for s in range(seeds)])
