"""Quality classifier: hashed word n-gram logistic regression, FTRL updates.

A text is two sequences of tokens of equal length: its words in lower case, and
their forms (runs of letters, capitals, digits or other characters become one
sign each; a word equal to the one before becomes a mark of repetition). Single
tokens and pairs of either sequence are hashed into one table of weights; a
text's score is a sparse dot product with its share of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.spans import LOWER, SPACE, hash_spans, lean, mix, slices, sums, words

BITS = 18
# Labelled texts that the model is fitted on, at most.
MAX_TRAINING = 8_000
EPOCHS = 4
# Rates of the updates, and the total of a text's shares.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
SCALE = 10.0
# Signs of a byte's form.
_SIGN = np.full(256, 0x21, np.uint8)
_SIGN[0x61:0x7B] = 0x61
_SIGN[0x80:] = 0x61
_SIGN[0x41:0x5B] = 0x41
_SIGN[0x30:0x3A] = 0x30
_SIGN[[0x2C, 0x2E, 0x3B, 0x3A]] = 0x2C
_SIGN[SPACE] = 0x20
_REPEAT = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_KINDS = (1, 2, 3, 4)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Table places of all n-grams, text by text, and where each text's begin."""
    begin, end, first = words(data, offsets)
    lower = hash_spans(LOWER[data], begin, end)
    forms = _forms(data, begin, end)
    head = np.zeros(len(begin), bool)
    starts = first[:-1][first[:-1] < first[1:]]
    head[starts] = True
    same = np.zeros(len(begin), bool)
    same[1:] = (lower[1:] == lower[:-1]) & ~head[1:]
    forms = np.where(same, _REPEAT, forms)
    columns = [lower, _pairs(lower, head), forms, _pairs(forms, head)]
    places = np.empty((len(begin), 4), np.int64)
    for i, (kind, values) in enumerate(zip(_KINDS, columns, strict=True)):
        places[:, i] = mix(values + np.uint64(kind * int(_PAIR) % 2 ** 64)) >> np.uint64(64 - bits)
    return places.ravel(), 4 * first


def _pairs(values: np.ndarray, head: np.ndarray) -> np.ndarray:
    before = np.zeros_like(values)
    before[1:] = values[:-1]
    before[head] = 0
    return before * _PAIR + values


def _forms(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word's signs, equal neighbours written once."""
    signs = _SIGN[data]
    kept = np.ones(len(signs), bool)
    kept[1:] = signs[1:] != signs[:-1]
    kept[begin] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    return hash_spans(signs[kept], place[begin], place[end])


def score(text: Column, model: Model) -> Column:
    """Probability of good quality, from 0 to 1, of a whole text; a null text is empty."""
    @F.arrow_udf("double")
    @lean
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [np.zeros(0)]
            for _, data, offsets in slices(batch):
                places, bounds = features(data, offsets, model.bits)
                total = sums(model.weights[places], bounds) * SCALE / np.maximum(np.diff(bounds), 1)
                out.append(1 / (1 + np.exp(-np.clip(total + model.bias, -30, 30))))
            yield pa.array(np.concatenate(out))

    return compute(text)


def fit(rows: DataFrame, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Fit on (doc_id, text, label), a bounded sample of labelled rows.

    Runs jobs when called: n-grams are counted where the texts are; one task
    then follows the regularised leader over the bounded sample, in the order
    of the hash. Rows without a label are not used; without any row, or with
    one class alone, the model is its bias.
    """
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn, label = batch.column(0), batch.column(1)
            for row, data, offsets in slices(batch.column(2)):
                places, bounds = features(data, offsets, bits)
                where, share = [], []
                for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                    found, times = np.unique(places[lo:hi], return_counts=True)
                    where.append(found.astype("<i4").tobytes())
                    share.append((times * SCALE / max(hi - lo, 1)).astype("<f4").tobytes())
                size = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [turn.slice(row, size), label.slice(row, size), pa.array(where, pa.binary()),
                     pa.array(share, pa.binary())], ["turn", "label", "places", "shares"])

    @lean
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(p.as_buffer(), "<i4"), np.frombuffer(s.as_buffer(), "<f4"), y.as_py())
                for batch in batches for y, p, s in zip(*batch.columns[1:], strict=True)]
        if rows:
            weights, bias = follow_leader(rows, 1 << bits, epochs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    sample = rows.filter("label is not null and doc_id is not null").select(
        F.xxhash64("doc_id", F.lit(7)).alias("turn"), F.col("label").cast("int").alias("label"), "text")
    counted = sample.mapInArrow(count, "turn bigint, label int, places binary, shares binary")
    one = counted.repartition(1).sortWithinPartitions("turn", "places")
    found = one.mapInArrow(learn, "weights binary, bias double").collect()
    if not found:
        return Model(np.zeros(1 << bits, np.float32), 0.0, bits)
    return Model(np.frombuffer(found[0]["weights"], "<f4"), found[0]["bias"], bits)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int,
                  epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias after `epochs` passes of per-coordinate FTRL with L1 and L2 terms."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for places, shares, y in rows:
            # Made anew each time: the sample is held once, as it came.
            p, x = np.append(places, size), np.append(shares.astype(float), 1.0)
            zp, root = z[p], np.sqrt(n[p])
            w = _leader(zp, root)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            grown = np.sqrt(n[p] + g * g)
            z[p] = zp + g - (grown - root) / ALPHA * w
            n[p] += g * g
    w = _leader(z, np.sqrt(n))
    return w[:size], float(w[size])


def _leader(z: np.ndarray, root: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + root) / ALPHA + L2))
