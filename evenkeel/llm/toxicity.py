"""Toxicity behind disguises: a noisy channel restores words, then the restored text is scored.

A token with signs for letters, letters apart or letters repeated is a lattice
of readings. Viterbi decoding finds the reading with the least cost under the
channel and a character model of the whole corpus. Other tokens have one
reading, themselves. The score comes from the words of the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.charmodel import CharModel

# The letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "tl", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "*": "aeioubcdfghjklmnpqrstvwxyz", "#": "aeiou",
    "%": "aeiou", "&": "aeiou", "?": "aeiou", "(": "c", "<": "c",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ԁ": "d",
    "α": "a", "ο": "o", "ε": "e", "ι": "i", "ı": "i",
}
APART = set(" .-_*~·•'`,/\\:;+=​‌‍­")
# Costs of the channel: a sign read as a letter, a sign or gap kept, a gap dropped, a run of three or more
# shortened, a double letter made one, and the same where a word has several double letters.
AS_LETTER, KEPT, DROPPED, SHORTENED, HALVED, HALVED_OFTEN = 0.7, 1.5, 0.3, 0.2, 6.0, 2.0
# What a word must gain by taking a sign at its edge for a letter.
GAIN = 2.0
_EDGE = ".,;:!?\"'()[]{}<>|*#%&-_/\\=~`"
# Letters that stand apart: by a few blanks, or by any white space that is the same between all of them.
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]{1,3}\S){2,}(?!\S)|(?<!\S)\S(\s+)\S(?:\1\S)+(?!\S)")
# What every row of letters apart contains, after white space.
_MAYBE_SPACED = re.compile(r"\s\S\s+\S\s+\S(?!\S)")
_DOUBLE = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1\1")
_DOUBLES = re.compile(r"(.)\1.*(.)\2")
# Letters, of which the second group is what all readings begin with, and at most one sign, at the end.
_ENDS_IN_SIGN = re.compile(r"(((?:([^\W\d_])(?!\3))++)[^\W\d_]*+)(?:([\W\d_])\4*+)?+[.,;:]*+")
_LOOKALIKES = frozenset(c for c in SIGNS if c.isalpha())
# Edge signs that may be the first letter of a word.
_OPENING = frozenset("!|")
# Edge signs that are a letter where the word is likelier with it than without.
_MAYBE_OPENING, _MAYBE_CLOSING = frozenset("*#%&?(<"), frozenset("*#%&")
_MAYBE = _OPENING | _MAYBE_OPENING | _MAYBE_CLOSING
# Paths through a lattice before its first place: their last three bytes to the cost and the letters so far.
_START = {0x202020: (0.0, b"")}
# Tokens whose reading a worker keeps; beyond, it starts anew.
KEPT_TOKENS = 500_000

PREFIXES = (4, 5, 6)
MAX_TRAINING = 12_000
TOP = 3
# Standard errors that a word's log odds are lowered by, and toxic texts it must occur in.
CAUTION, LEAST = 2.0, 2


class Decoder:
    """Restores tokens; keeps what it has read."""

    def __init__(self, model: CharModel):
        self.model = model
        self.read: dict[str, str] = {}

    def token(self, token: str) -> str:
        """The reading of a lowered token without white space."""
        if plain(token):
            return token
        bare = token.strip(_EDGE)
        if plain(bare) and _MAYBE.isdisjoint(token):
            return bare
        if token and token[0] in _OPENING and bare:
            before = token[:token.index(bare)][-1:]
            bare = before + bare if before in _OPENING else bare
        if not bare or not any(map(str.isalpha, bare)):
            return bare
        edged = edges(token, bare)
        if edged == bare and plain(bare):
            return bare
        found = self.read.get(edged)
        if found is None:
            if len(self.read) >= KEPT_TOKENS:
                self.read = {}
            found = self.read[edged] = self._read(edged, bare)
        return found

    def _read(self, edged: str, bare: str) -> str:
        if edged == bare:
            return self.viterbi(bare) if disguised(bare) else bare
        paths = self._paths(lattice(bare), _START)
        without, reading = self._ended(paths)
        # A sign at the end alone goes on from the same paths.
        with_sign, other = (self._ended(self._paths(lattice(edged[len(bare):]), paths)) if edged.startswith(bare)
                            else self.decode(edged))
        return other if with_sign + GAIN < without else reading

    def spaced(self, text: str) -> str:
        """The reading of letters that stand apart."""
        return self.viterbi(text)

    def viterbi(self, text: str) -> str:
        """The reading on the path of least cost through the lattice of `text`."""
        return self.decode(text)[1]

    def decode(self, text: str) -> tuple[float, str]:
        """The least cost and its reading."""
        return self._ended(self._paths(lattice(text), _START))

    def _paths(self, places: list[list[tuple[float, bytes]]],
               paths: dict[int, tuple[float, bytes]]) -> dict[int, tuple[float, bytes]]:
        """The path of least cost to each state after `places`, which follow `paths`."""
        known = self.model.known
        at = 0
        if len(paths) == 1:
            # As long as there is one path, there is nothing to compare.
            [(state, (total, out))] = paths.items()
            for choices in places:
                if len(choices) > 1:
                    break
                extra, letters = choices[0]
                at += 1
                total += extra
                if letters == b" " and state & 0xFF == 0x20:
                    continue
                for byte in letters:
                    window = state << 8 | byte
                    total += known[window]
                    state = window & 0xFFFFFF
                out += letters
            paths = {state: (total, out)}
        for choices in places[at:]:
            following: dict[int, tuple[float, bytes]] = {}
            for last, (total, out) in paths.items():
                for extra, letters in choices:
                    state, sum_, written = last, total + extra, out
                    if letters != b" " or state & 0xFF != 0x20:
                        for byte in letters:
                            window = state << 8 | byte
                            sum_ += known[window]
                            state = window & 0xFFFFFF
                        written += letters
                    best = following.get(state)
                    if best is None or sum_ < best[0] or sum_ == best[0] and written < best[1]:
                        following[state] = (sum_, written)
            paths = following
        return paths

    def _ended(self, paths: dict[int, tuple[float, bytes]]) -> tuple[float, str]:
        """The least cost of whole paths and its reading."""
        known = self.model.known
        total, out = min((total + (known[last << 8 | 0x20] if last & 0xFF != 0x20 else 0.0), out)
                         for last, (total, out) in paths.items())
        return total, out.decode("utf-8", "ignore").strip()


def edges(token: str, bare: str) -> str:
    """`bare` with the signs next to it in `token` that may be letters."""
    at = token.index(bare)
    before, after = token[:at][-1:], token[at + len(bare):][:1]
    return (before if before in _MAYBE_OPENING else "") + bare + (after if after in _MAYBE_CLOSING else "")


def plain(word: str) -> bool:
    """True if a word has one reading: letters alone, none a lookalike or three times in a row, one double at most."""
    return (word.isalpha() and (word.isascii() or _LOOKALIKES.isdisjoint(word))
            and not (_DOUBLE.search(word) and (_RUN.search(word) or _DOUBLES.search(word))))


def spaced(text: str) -> Iterator[re.Match]:
    """The rows of letters that stand apart in a lowered text."""
    return _SPACED.finditer(text) if _MAYBE_SPACED.search(" " + text) else iter(())


def disguised(token: str) -> bool:
    """True if a token has signs for letters, gaps between letters, a letter three times or several doubles."""
    return any(c in SIGNS or c in APART for c in token) or bool(_RUN.search(token) or _DOUBLES.search(token))


@lru_cache(maxsize=1 << 16)
def _readings(sign: str, run: int, halved: float) -> list[tuple[float, bytes]]:
    """Readings of a sign that stands `run` times, three for more; the list is shared."""
    readings = []
    letters = sign if sign.isalpha() and sign not in SIGNS else SIGNS.get(sign, "")
    price = 0.0 if sign == letters else AS_LETTER
    for letter in letters:
        one = letter.encode()
        if run == 1:
            readings.append((price, one))
        else:
            long = run > 2
            readings += [(price + (SHORTENED if long else halved), one), (price + SHORTENED * long, 2 * one)]
    if sign in APART or sign.isspace():
        readings += [(DROPPED, b""), (KEPT, b" ")]
    elif not letters or sign in SIGNS:
        readings.append((KEPT, b" "))
    return readings


def lattice(text: str) -> list[list[tuple[float, bytes]]]:
    """For each place, in order, its readings with the cost of the channel."""
    out: list[list[tuple[float, bytes]]] = []
    halved = HALVED_OFTEN if _DOUBLES.search(text) else HALVED
    at = 0
    while at < len(text):
        sign = text[at]
        end = at + 1
        while end < len(text) and text[end] == sign:
            end += 1
        out.append(_readings(sign, min(end - at, 3), halved))
        at = end
    return out


def tokens(text: str, decoder: Decoder) -> set[str]:
    """The distinct words of the restored text."""
    lowered = text.lower()
    found: set[str] = set()
    for token in set(lowered.split()):
        found.update(decoder.token(token).split())
    for match in spaced(lowered):
        found.update(decoder.spaced(match.group()).split())
    return found


def restored(text: str, decoder: Decoder) -> str:
    """The whole text with each token's reading, letters apart joined first; white space stays."""
    lowered = _SPACED.sub(lambda m: decoder.spaced(m.group()), text.lower())
    return re.sub(r"\S+", lambda m: decoder.token(m.group()), lowered)


def features(words: set[str]) -> list[str]:
    """The distinct features of distinct words: a word, and what longer words begin with."""
    found = ["w:" + word for word in words]
    for n in reversed(PREFIXES):
        # What is shorter begins like what is longer.
        words = {word[:n] for word in words if len(word) >= PREFIXES[0]}
        found += [f"{n}:{word}" for word in words if len(word) == n]
    return found


@dataclass(frozen=True)
class Model:
    """Totals of the character model, log odds of features, and the weights of the highest odds."""

    totals: np.ndarray
    odds: dict[str, float]
    weights: tuple[float, ...]


def restore(text: Column, totals: np.ndarray) -> Column:
    """The restored text: lower case, disguised words read, white space as it was; null stays null."""
    @F.arrow_udf("string")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(CharModel(totals))
        for batch in batches:
            yield pa.array([None if t is None else restored(t, decoder) for t in map(pa.Scalar.as_py, batch)],
                           pa.string())

    return compute(text)


def score(text: Column, model: Model) -> Column:
    """Probability, from 0 to 1, that a whole text is toxic; a null text is empty."""
    @F.arrow_udf("double")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(CharModel(model.totals))
        known = Evidence(decoder, model.odds)
        for batch in batches:
            yield pa.array([_logistic(known.top(text.as_py() or ""), model.weights) for text in batch], pa.float64())

    return compute(text)


def _logistic(values: list[float], weights: tuple[float, ...]) -> float:
    z = weights[0] + sum(w * v for w, v in zip(weights[1:], values, strict=True))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Evidence(dict):
    """Token to the word that it is read as and its log odds, or None; tokens without any are kept as well."""

    def __init__(self, decoder: Decoder, odds: dict[str, float]):
        super().__init__()
        self.decoder = decoder
        # The odds of whole words, and the highest odds of what longer words begin with.
        self.words: dict[str, float] = {}
        self.starts: dict[str, float] = {}
        for name, value in sorted(odds.items()):
            # Shorter beginnings come first, whole words last.
            kind, _, word = name.partition(":")
            if (best := max(value, self.begins(word))) > 0:
                (self.words if kind == "w" else self.starts)[word] = best
        # Beginnings of whole words, which may be written in chunks, with the highest odds of these words; then with the
        # words themselves.
        self.begun: dict[str, float] = {}
        for word, value in self.words.items():
            for n in range(1, len(word)):
                self.begun[word[:n]] = max(value, self.begun.get(word[:n], 0.0))
        self.grown = self.begun | {word: max(value, self.begun.get(word, 0.0)) for word, value in self.words.items()}
        # All that may go on to have log odds.
        self.heads = self.grown.keys() | {start[:n] for start in self.starts for n in range(1, len(start) + 1)}
        # Tokens read as several words with log odds.
        self.several: dict[str, dict[str, float]] = {}

    def __missing__(self, token: str) -> tuple[str, float] | None:
        reading = token if plain(token) else "" if self.vain(token) else self.decoder.token(token)
        if " " in reading:
            found = self.of(reading)
            if len(found) > 1:
                self.several[token] = found
            pair = next(iter(found.items()), None)
        else:
            value = self.value(reading)
            pair = (reading, value) if value else None
        self[token] = pair
        return pair

    def vain(self, token: str) -> bool:
        """True if a token is read as one word, whose beginning alone shows that it has no log odds."""
        found = _ENDS_IN_SIGN.fullmatch(token)
        if found is None:
            return False
        letters, start = found.group(1, 2)
        return (start not in self.heads and not self.begins(start) and letters.isalpha()
                and (letters.isascii() or _LOOKALIKES.isdisjoint(letters)))

    def begins(self, word: str) -> float:
        """The highest log odds of what a word begins with, or 0."""
        known = self.starts.get
        return known(word[:PREFIXES[2]]) or known(word[:PREFIXES[1]]) or known(word[:PREFIXES[0]]) or 0.0

    def value(self, word: str) -> float:
        """The log odds of a word, or 0."""
        return self.words.get(word) or self.begins(word)

    def of(self, reading: str) -> dict[str, float]:
        return {word: value for word in reading.split() if (value := self.value(word))}

    def chunked(self, parts: list[str], distinct: set[str], above: float) -> Iterator[str]:
        """Known words with log odds above a value that neighbouring parts make up, the lattice of all being read so."""
        begun, grown = self.begun.get, self.grown.get
        first = {part for part in self.begun.keys() & distinct if self.begun[part] > above}
        # Most neighbours begin nothing together.
        for at in [at for at, (part, after) in enumerate(zip(parts, parts[1:]))
                   if part in first and grown(part + after.strip(_EDGE), 0.0) > above]:
            word, end = parts[at], at + 1
            while end < len(parts) and begun(word, 0.0) > above:
                last = parts[end].strip(_EDGE)
                word, end = word + last, end + 1
                if (self.words.get(word, 0.0) > above
                        and self.decoder.viterbi(" ".join([*parts[at:end - 1], last])) == word):
                    yield word
                if last != parts[end - 1]:
                    break

    def top(self, text: str, chunks: bool = True) -> list[float]:
        """The highest log odds among the distinct words of the restored text, in falling order; words in chunks too."""
        if len(self) >= KEPT_TOKENS:
            self.clear()
            self.several.clear()
        lowered = text.lower()
        parts = lowered.split()
        distinct = set(parts)
        words: dict[str, float] = dict(filter(None, map(self.__getitem__, distinct)))
        if not self.several.keys().isdisjoint(distinct):
            for token in self.several.keys() & distinct:
                words.update(self.several[token])
        if chunks:
            # A word that is not above the least of the highest would change nothing.
            for word in self.chunked(parts, distinct, _highest(words)[-1]):
                words[word] = self.words[word]
        for match in spaced(lowered):
            words.update(self.of(self.decoder.spaced(match.group())))
        return _highest(words)


def _highest(words: dict[str, float]) -> list[float]:
    return (sorted(words.values(), reverse=True) + [0.0] * TOP)[:TOP]


def fit(rows: DataFrame, totals: np.ndarray) -> Model:
    """Fit on (doc_id, text, label), a bounded sample of labelled rows, with the corpus's character counts.

    Runs jobs when called. Features are counted by Spark; the log odds of each
    are lowered by its uncertainty, and those above zero are kept, which the
    sample bounds. The weights of the highest odds are fitted with every text's
    own share taken out of the counts. Without both classes the score is 0.
    """
    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(CharModel(totals))
        for batch in batches:
            found = [features(tokens(t.as_py() or "", decoder)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))],
                                             ["label", "features"])

    labelled = rows.filter("label is not null").select(F.col("label").cast("int").alias("label"), "text")
    sizes = {row["label"]: row["n"] for row in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(totals, {}, (-30.0,) + (0.0,) * TOP)
    counts = (labelled.mapInArrow(words_of, "label int, features array<string>")
              .select("label", F.explode("features").alias("feature")).groupBy("feature")
              .agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
              .filter(F.col("toxic") >= LEAST))
    table = counts.filter(_odds_column(toxic, clean) > 0).toArrow().to_pydict()
    seen = dict(zip(table["feature"], zip(table["toxic"], table["clean"], strict=True), strict=True))

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(CharModel(totals))
        # The evidence without a toxic text, a clean text, and a text of another label.
        without = {(x, y): Evidence(decoder, {f: _odds(a - x, b - y, toxic - x, clean - y)
                                              for f, (a, b) in seen.items() if b >= y})
                   for x, y in ((True, False), (False, True), (False, False))}
        for batch in batches:
            rows = [without[label == 1, label == 0].top(text.as_py() or "", chunks=False) for label, text in
                    zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))],
                                             ["label", "values"])

    found = labelled.mapInArrow(highest, "label int, values array<double>").collect()
    weights = _logistic_fit(np.array([row["values"] for row in found]), np.array([row["label"] for row in found]))
    return Model(totals, {f: _odds(a, b, toxic, clean) for f, (a, b) in seen.items()}, weights)


def _odds(toxic: float, clean: float, all_toxic: int, all_clean: int) -> float:
    if toxic < LEAST:
        return 0.0
    a, b = toxic + 0.5, clean + 0.5
    return log(a / (all_toxic + 1)) - log(b / (all_clean + 1)) - CAUTION * sqrt(1 / a + 1 / b)


def _odds_column(all_toxic: int, all_clean: int) -> Column:
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.log(a / (all_toxic + 1)) - F.log(b / (all_clean + 1)) - CAUTION * F.sqrt(1 / a + 1 / b)


def _logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> tuple[float, ...]:
    """Newton's method for a logistic regression of a few columns."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, gradient)
    return tuple(map(float, w))
