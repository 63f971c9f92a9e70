"""Column expressions over page and recipe text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions import patterns as P


def clean_html(html: Column, keep_pipes: bool = False) -> Column:
    """Page without script and style elements, blanks collapsed to one space.

    The page is read tag by tag, each element that holds no tags as a whole (`RX_NONTEXT`).
    """
    blanks = P.RX_BLANKS_KEEP_PIPES if keep_pipes else P.RX_BLANKS
    return F.regexp_replace(F.regexp_replace(html, P.RX_NONTEXT, "$1$2"), blanks, " ")


def strip_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(P.WHITE_SPACE))


def response_text(title: Column, ingredients: Column, directions: Column) -> Column:
    """Target text; null if any part is null."""
    newline = F.lit("\n")
    return F.concat(title, newline, ingredients, newline, directions)


def json_steps(directions: Column) -> Column:
    """JSON list of strings to an array."""
    return F.from_json(directions, "array<string>")


def step_sentences(step: Column) -> Column:
    """Sentences of one step; `; ` ends a sentence like a full stop does."""
    dotted = F.replace(step, F.lit("; "), F.lit(". "))
    return F.transform(F.regexp_extract_all(dotted, F.lit(P.RX_SENTENCE), F.lit(0)), strip_blank)


def sentence_words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(P.RX_WORD), F.lit(0))


def word_pairs(words: Column, verbs: Sequence[str], particles: Sequence[str], gap: int) -> Column:
    """`verb particle` pairs of the words of one sentence, in particle order.

    `words` must be a bound value (a lambda's variable or a column): an
    expression would be worked out again for each word.

    A particle goes with the nearest verb among the `gap` words before it, as
    it has one head at most.
    """
    def pair(word: Column, at: Column) -> Column:
        before = F.slice(words, F.greatest(at - gap + 1, F.lit(1)), F.least(F.lit(gap), at))
        heads = F.filter(before, lambda w: w.isin(list(verbs)))
        head = F.try_element_at(heads, F.lit(-1))
        return F.when(word.isin(list(particles)), F.concat(head, F.lit(" "), word))

    return F.array_compact(F.transform(words, pair))
