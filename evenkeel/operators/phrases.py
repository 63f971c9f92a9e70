"""Recipe directions: sentences, verb and particle pairs, annotation hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import text as X

# Default lexicons of the phrase search.
VERBS = (
    "add", "beat", "blend", "boil", "break", "bring", "brush", "chop", "cook", "cool", "cover",
    "cut", "drain", "dry", "fold", "heat", "keep", "lay", "leave", "lift", "mix", "peel", "pour",
    "pull", "put", "roll", "rub", "scoop", "scrape", "set", "simmer", "slice", "spread",
    "sprinkle", "squeeze", "stir", "take", "top", "trim", "turn", "warm", "wash", "whip", "wipe",
)
PARTICLES = ("around", "away", "back", "down", "in", "off", "on", "out", "over", "together", "up")
GAP = 4


def direction_sentences(df: DataFrame, key: str, directions: str = "directions",
                        keep_empty: bool = True) -> DataFrame:
    """(key, step, sentence_no, sentence) of a JSON list of steps.

    Positions count from 0. With `keep_empty` a step or list without sentence
    gives one row with a null sentence. Rows are unrolled where they are read.
    """
    unroll = F.posexplode_outer if keep_empty else F.posexplode
    steps = df.select(key, unroll(X.json_steps(F.col(directions))).alias("step", "text"))
    return steps.select(key, "step",
                        unroll(X.step_sentences(F.col("text"))).alias("sentence_no", "sentence"))


def phrasal_pairs(df: DataFrame, directions: str = "directions", verbs: Sequence[str] = VERBS,
                  particles: Sequence[str] = PARTICLES, gap: int = GAP) -> DataFrame:
    """Add `pairs`: the verb and particle pairs of a recipe in text order.

    A word-list approximation of a dependency search, within one sentence and
    `gap` words. A recipe is one row before and after: nothing is shuffled.
    """
    def in_step(step):
        words = F.transform(X.step_sentences(step), X.sentence_words)
        return F.flatten(F.transform(words, lambda w: X.word_pairs(w, verbs, particles, gap)))

    steps = F.filter(X.json_steps(F.col(directions)), lambda s: s.isNotNull())
    return df.withColumn("pairs", F.flatten(F.transform(steps, in_step)))


def annotate(df: DataFrame, load_annotator: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
             schema: str) -> DataFrame:
    """Run a user's annotator over batches of rows; it is loaded once per task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        annotator = load_annotator()
        for batch in batches:
            yield annotator(batch)

    return df.mapInPandas(run, schema)
