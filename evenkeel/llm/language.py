"""Language identification in two steps: the family, then the language inside it.

Both steps are one-versus-one linear support vector machines over hashed
character windows: families against each other, then the languages of the
winning family. A decision is a sparse dot product with the share of each
window in the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.spans import lean, slices

UNKNOWN = "und"
# Families of languages by ISO 639-1 code; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
    "semitic": "am ar he mt",
    "indic": "bn gu hi mr ne pa ur",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

BITS = 16
ORDERS = (2, 3, 4)
_TURN = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
# Texts per language that the machines are fitted on, about; and passes over them.
PER_LANGUAGE = 1_500
PASSES = 12
# Total of a text's shares, cost of a violated margin, steepness of the confidence.
SCALE, COST, STEEP = 20.0, 0.2, 3.0
_PAD = 3
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


@dataclass(frozen=True)
class Model:
    """Weights of machine i, `pairs[i]`: above zero speaks for the first, below for the second."""

    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray
    biases: np.ndarray
    languages: tuple[str, ...]


def family(code: str) -> str:
    return FAMILY_OF.get(code, f"other:{code}")


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table places of all windows, text by text, and where each text's begin.

    Windows are of two to four bytes of the lowered text, with anything but
    letters as space and space around the text; those of space alone are left out.
    """
    sizes = np.diff(offsets)
    count = len(sizes)
    padded = np.full(len(data) + _PAD * (count + 1), 0x20, np.uint8)
    shift = np.repeat(_PAD * np.arange(1, count + 1), sizes)
    padded[np.arange(len(data)) + shift] = np.where(_LETTER[data], data, 0x20)
    full = padded != 0x20
    ends = np.flatnonzero(full[_PAD:] | full[_PAD - 1:-1]) + _PAD
    bounds = np.searchsorted(ends, offsets + _PAD * np.arange(1, count + 2) - 1)
    bounds[0], bounds[-1] = 0, len(ends)
    value = padded[ends].astype(np.uint32)
    places = np.empty((len(ends), len(ORDERS)), np.uint32)
    for back in range(1, max(ORDERS)):
        value = value | (padded[ends - back].astype(np.uint32) << np.uint32(8 * back))
        if back + 1 in ORDERS:
            i = ORDERS.index(back + 1)
            places[:, i] = (value * np.uint32(_TURN[i]) + np.uint32(_TURN[i] % 65521)) >> np.uint32(32 - BITS)
    return places.ravel(), len(ORDERS) * bounds


def predict(text: Column, model: Model) -> Column:
    """struct(lang_pred, score) of a whole text.

    `und`, with score 0, for a text that is null or has no letter, and for
    every text if the model knows no language. The score is the confidence of
    the least certain decision.
    """
    @F.arrow_udf("struct<lang_pred: string, score: double>")
    @lean
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for row, data, offsets in slices(pc.utf8_lower(pc.fill_null(batch, ""))):
                found, sure = decide(margins(data, offsets, model), model)
                known = lettered(batch, row, data, offsets) & (len(model.languages) > 0)
                names += [name if ok else UNKNOWN for name, ok in zip(found, known, strict=True)]
                scores.append(np.where(known, sure, 0.0))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                                             ["lang_pred", "score"])

    return compute(text)


def lettered(texts: pa.Array, row: int, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True for texts with a letter of any script."""
    ascii_letters = np.concatenate([[0], np.cumsum((data >= 0x61) & (data <= 0x7A))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, texts[row + int(i)].as_py() or ""))
    return found


def margins(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """The decision of every machine for every text."""
    places, bounds = windows(data, offsets)
    counts = np.maximum(np.diff(bounds), 1)
    full = np.flatnonzero(bounds[:-1] < bounds[1:])
    out = np.tile(model.biases, (len(counts), 1))
    for i in range(len(model.pairs)):
        if len(full):
            total = np.add.reduceat(model.weights[i][places], bounds[:-1][full], dtype=np.float64)
            out[full, i] += SCALE * total / counts[full]
    return out


def decide(margin: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and confidence: families vote first, then the languages of the winner."""
    families = tuple(dict.fromkeys(map(family, model.languages)))
    winner, sure = _vote(margin, model, families)
    names, out = [""] * len(margin), sure
    for name in families:
        rows = np.flatnonzero([w == name for w in winner])
        members = tuple(code for code in model.languages if family(code) == name)
        inside, certain = _vote(margin[rows], model, members)
        out[rows] = np.minimum(out[rows], certain)
        for row, code in zip(rows, inside, strict=True):
            names[row] = code
    return names, out


def _vote(margin: np.ndarray, model: Model, names: tuple[str, ...]) -> tuple[list[str], np.ndarray]:
    """Most duels won, then the greatest sum of margins; confidence in the closest duel of the winner."""
    if not names:
        return [UNKNOWN] * len(margin), np.zeros(len(margin))
    place = {name: i for i, name in enumerate(names)}
    won, total = np.zeros((len(margin), len(names))), np.zeros((len(margin), len(names)))
    least = np.full((len(margin), len(names)), np.inf)
    for i, (a, b) in enumerate(model.pairs):
        if a in place and b in place:
            for name, m in ((a, margin[:, i]), (b, -margin[:, i])):
                won[:, place[name]] += m > 0
                total[:, place[name]] += m
                least[:, place[name]] = np.minimum(least[:, place[name]], m)
    best = (won + np.tanh(total / 1e3) / 2).argmax(axis=1)
    close = least[np.arange(len(margin)), best]
    return [names[i] for i in best], 1 / (1 + np.exp(-np.clip(STEEP * close, -30, 30)))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, passes: int = PASSES) -> Model:
    """Fit on about `per_language` rows of each language of (doc_id, text, lang), by a hash of doc_id.

    Runs jobs when called. Windows are counted where the texts are; one task
    fits the machines on the bounded sample. Rows without a language, text or
    doc_id are not used; without any row the model knows no language, with one
    language it always names that.
    """
    rows = docs.filter("lang is not null and text is not null and doc_id is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    # One row per language, of which the model holds a table for each pair: few, and broadcast.
    sample = rows.select("doc_id", "lang", "text").join(F.broadcast(sizes), "lang").filter(draw * F.col("_rows") < per_language)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(pc.utf8_lower(batch.column(2))):
                places, bounds = windows(data, offsets)
                where, share = [], []
                for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                    found, times = np.unique(places[lo:hi], return_counts=True)
                    where.append(found.astype("<i4").tobytes())
                    share.append((SCALE * times / max(hi - lo, 1)).astype("<f4").tobytes())
                size = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, size), batch.column(1).slice(row, size),
                     pa.array(where, pa.binary()), pa.array(share, pa.binary())],
                    ["turn", "lang", "places", "shares"])

    @lean
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(code.as_py(), np.frombuffer(p.as_buffer(), "<i4"), np.frombuffer(s.as_buffer(), "<f4"))
                for batch in batches for code, p, s in zip(*batch.columns[1:], strict=True)]
        codes = sorted({code for code, _, _ in seen})
        yield _row("", "", np.zeros(0), 0.0, codes)
        for a, b, of in _duels(codes):
            rows = [(p, x, 1.0 if of(code) == a else -1.0) for code, p, x in seen if of(code) in (a, b)]
            yield _row(a, b, *machine(rows, 1 << BITS, passes), [])

    counted = sample.select(F.xxhash64("doc_id", F.lit(11)).alias("turn"), "lang", "text").mapInArrow(
        count, "turn bigint, lang string, places binary, shares binary")
    one = counted.repartition(1).sortWithinPartitions("turn", "lang", "places")
    found = one.mapInArrow(learn, "a string, b string, weights binary, bias double, codes array<string>").collect()
    codes = tuple(code for row in found for code in row["codes"])
    duels = [row for row in found if row["a"]]
    return Model(tuple((row["a"], row["b"]) for row in duels),
                 np.array([np.frombuffer(row["weights"], "<f4") for row in duels]),
                 np.array([row["bias"] for row in duels]), codes)


def _row(a: str, b: str, weights: np.ndarray, bias: float, codes: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"a": a, "b": b, "weights": weights.astype("<f4").tobytes(), "bias": bias, "codes": codes}],
        pa.schema([("a", pa.string()), ("b", pa.string()), ("weights", pa.binary()), ("bias", pa.float64()),
                   ("codes", pa.list_(pa.string()))]))


def _duels(codes: list[str]) -> list[tuple]:
    """Families against each other, then the languages inside each family."""
    families = sorted({family(code) for code in codes})
    inside = [pair for name in families for pair in combinations([c for c in codes if family(c) == name], 2)]
    return [(a, b, family) for a, b in combinations(families, 2)] + [(a, b, str) for a, b in inside]


def machine(rows: list[tuple[np.ndarray, np.ndarray, float]], size: int, passes: int) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate ascent; rows are (places, values, +1 or -1)."""
    w, bias = np.zeros(size), 0.0
    norms = [float(x.astype(float) @ x.astype(float)) + 1.0 for _, x, _ in rows]
    dual = np.zeros(len(rows))
    for _ in range(passes):
        for i, (p, shares, y) in enumerate(rows):
            x = shares.astype(float)
            step = dual[i] - (y * (w[p] @ x + bias) - 1) / norms[i]
            step = min(max(step, 0.0), COST)
            if step != dual[i]:
                moved = (step - dual[i]) * y
                w[p] += moved * x
                bias += moved
                dual[i] = step
    return w, bias
