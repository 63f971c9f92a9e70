"""Vector codes, collision search and hard negatives against brute force."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import codes, collisions, negatives, queries, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"
SF = "/root/testdata/sf0.01"


def clash(frame):
    """Columns whose names the operators use themselves."""
    names = ("ids", "code", "error", "row", "dim", "segment", "block", "tree", "anchor", "score", "rank", "least", "_key")
    return frame.select("*", *(F.lit(1).alias(n) for n in names))


def made(count, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    rows = [(i, (base[i % 12] * rng.choice([0.3, 1, 2]) + rng.normal(size=dim) * 0.4).astype("f4").tolist(), i % 5)
            for i in range(count)]
    rows += [(count + i, rows[0][1], 0) for i in range(count // 2)]  # a third are copies
    at = 2 * count
    return rows + [(at, None, 1), (at + 1, [float("nan")] * dim, 1), (at + 2, [None] + [1.0] * (dim - 1), 2),
                   (at + 3, [float("inf")] + [0.0] * (dim - 1), 2), (at + 4, [0.0] * dim, None), (at + 5, rows[3][1], None)]


def ok(vector):
    return vector is not None and all(v is not None and np.isfinite(v) for v in vector)


# Codes

def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted((r for r in rows if ok(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))
    width = -(-max(len(r[1]) for r in kept) // parts) * parts
    x = [[int(np.floor(v * 256)) for v in r[1]] + [0] * (width - len(r[1])) for r in kept]
    size = width // parts
    books = [[row[p * size:(p + 1) * size] for row in x[:entries]] for p in range(parts)]

    def near(row, p):
        part = row[p * size:(p + 1) * size]
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), i) for i, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for row in x:
                groups[near(row, p)[1]].append(row[p * size:(p + 1) * size])
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i], strict=True)] if i in groups else entry
                        for i, entry in enumerate(books[p])]
    found = [[near(row, p) for p in range(parts)] for row in x]
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    by = collections.Counter()
    for r, f in zip(kept, found, strict=True):
        by[r[2]] += sum(d for d, _ in f)
    return collections.Counter((r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), by[r[2]],
                                hashlib.sha256(text.encode()).hexdigest()) for r, f in zip(kept, found, strict=True))


def test_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 50)  # several dictionaries
    rows = made(120, 32)
    found = codes.compress(clash(spark.createDataFrame(rows, SCHEMA)).repartition(5)).collect()
    assert collections.Counter(tuple(r) for r in found) == brute_codes(rows)


def test_codes_of_edges(spark):
    assert codes.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    rows = [(3, [1.0, 2.0, 3.0], 0), (1, [-1.0], None), (1, [-1.0], None), (None, [0.5], 1), (2, [], 1)]
    found = codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert collections.Counter(tuple(r) for r in found) == brute_codes(rows)
    empty = codes.compress(spark.createDataFrame([(2, [], 1)], SCHEMA)).first()
    assert (empty.code, empty.error) == ("00" * 16, 0)
    assert codes.compress(spark.createDataFrame([(1, [3e38] * 16, 0), (2, [-3e38] * 16, 0)], SCHEMA)).count() == 2


def test_totals_join_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", -1)
    rows = made(60, 16)
    found = codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert collections.Counter(tuple(r) for r in found) == brute_codes(rows)


def test_dictionaries_give_back_the_vectors():
    x = vectors.whole(np.random.default_rng(1).normal(size=(40, 8)))
    dictionaries, coded = codes.encode(x)
    assert (np.array([d[c] for d, c in zip(dictionaries, coded, strict=True)]).T == x).all()
    assert all((np.diff(d) > 0).all() for d in dictionaries)


# Search

def brute_search(rows, asked, k):
    rows = [(r[0], np.array(r[1], float)) for r in rows if r[0] is not None and ok(r[1]) and any(r[1])]
    out = {}
    for own, q in ((i, v) for i, v in rows if i in asked):
        scored = sorted((-float((v * q).sum()), i) for i, v in rows if i != own and len(v) == len(q))
        out[own] = [(i, -s) for s, i in scored[:k]]
    return out


def ranked(found):
    out = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


@pytest.mark.parametrize("segment", [8192, 100])
def test_search_finds_what_brute_force_finds(spark, monkeypatch, segment):
    monkeypatch.setattr(collisions, "SEGMENT", segment)
    monkeypatch.setattr(collisions, "BLOCK", 16)
    rows = made(600)
    asked = {r[0] for r in rows if r[0] % 9 == 0}
    frame = clash(spark.createDataFrame(rows, SCHEMA))
    found = ranked(collisions.search(frame, frame.filter("vec_id % 9 = 0"), 20).collect())
    expected = brute_search(rows, asked, 20)
    assert found.keys() == expected.keys()
    met = 0
    for own, best in expected.items():
        exact = dict(brute_search(rows, {own}, len(rows))[own])
        assert len(found[own]) == 20
        assert all(exact[i] == pytest.approx(s, rel=1e-12) for i, s in found[own])
        assert found[own] == sorted(found[own], key=lambda r: (-r[1], r[0]))
        met += len({i for i, _ in best} & {i for i, _ in found[own]})
    assert met >= 0.95 * 20 * len(expected)


def test_recall_on_the_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = ranked(queries.op12_collision_search(spark, SF).collect())
    expected = brute_search(rows, {r[0] for r in rows if r[0] % 20 == 0}, 20)
    assert found.keys() == expected.keys()
    met = sum(len({i for i, _ in best} & {i for i, _ in found[own]}) for own, best in expected.items())
    assert met >= 0.95 * sum(map(len, expected.values()))


def test_search_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collisions.search(none, none).count() == 0
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 0), (3, [0.0, 0.0], 0),
            (4, [1.0, 0.0, 0.0], 0), (None, [5.0, 5.0], 0), (5, None, 0), (6, [], 0), (7, [-1.0, 3e38], 0), (2, [0.5, 1.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = collections.defaultdict(list)
    for r in sorted(collisions.search(frame, frame).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert found[0] == [(1, 2, 2.0), (2, 1, 1.0), (3, 2, 0.5), (4, 7, -1.0)]
    assert sorted(found[2]) == sorted([(1, 0, 2.0), (2, 1, 2.0), (3, 7, -2.0)] + [
        (rank, i, pytest.approx(s)) for rank, (i, s) in enumerate([(7, -0.5 + np.float32(3e38)), (0, 0.5), (1, 0.5)], 1)])
    assert 4 not in found and 3 not in found


def test_only_vectors_met_often_enough_are_verified():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(30, 32)) * 0.05 + 1, rng.normal(size=(3000, 32))])
    lines = collisions.random_lines(32, collisions.LINES)
    segment = collisions.Segment.of(np.arange(len(x)), x / np.linalg.norm(x, axis=1, keepdims=True), lines)
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            seen.append(len(key))
            return np.asarray(self)[key]

    segment.x = segment.x.view(Watched)
    query = np.ones(32)
    place, _ = collisions.nearest_in(segment, query, -1, (query / np.linalg.norm(query)) @ lines[:-1], 10)
    assert (place < 30).all() and sum(seen) < 1500


# Hard negatives

def brute_negatives(rows, anchors, k=5, n=3, least=50, most=95):
    kept = [(i, [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v], label) for i, v, label in rows
            if i is not None and label is not None and ok(v)]
    out = collections.Counter()
    for own, a, label in kept:
        if own not in anchors:
            continue
        met = sorted((-sum(p * q for p, q in zip(a, b, strict=True)), i, other) for i, b, other in kept if len(a) == len(b))
        for ps, pos, _ in [m for m in met if m[2] == label and m[1] != own][:k]:
            window = [m for m in met if m[2] != label and -least * ps <= -100 * m[0] <= -most * ps][:n]
            for rank, (ns, neg, _) in enumerate(window, 1):
                out[own, pos, rank, neg, -ps, -ns] += 1
    return out


@pytest.mark.parametrize("values", [1 << 18, 256])
def test_negatives_equal_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(negatives, "TREE_VALUES", values)  # many small trees
    monkeypatch.setattr(negatives, "SAMPLE", 200)
    monkeypatch.setattr(negatives, "ROOTS", 7)
    monkeypatch.setattr(negatives, "ANCHORS", 9)
    rows = made(300)
    frame = clash(spark.createDataFrame(rows, SCHEMA))
    found = negatives.hard_negatives(frame, frame.filter("vec_id % 11 = 0")).collect()
    expected = brute_negatives(rows, {r[0] for r in rows if r[0] % 11 == 0})
    assert collections.Counter(tuple(r) for r in found) == expected and len(expected) > 50


def test_negative_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(none, none).count() == 0
    rows = [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [0.9, 0.9], 1), (3, [0.9, 0.9], 1),
            (4, [0.8, 0.8], 2), (5, [-1.0, -1.0], 0), (6, [1.0, 1.0, 1.0], 0), (7, [], 0), (8, [], 1), (9, None, 1),
            (10, [0.1, 0.1], 1), (None, [0.9, 0.9], 1), (11, [2e5, 3e9], 0), (12, [1e5, 1e9], 3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = collections.Counter(tuple(r) for r in negatives.hard_negatives(frame, frame.filter("vec_id < 11")).collect())
    distinct = dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows)
    held = [(i, v and [max(min(x, 262144.0), -262144.0) for x in v], label) for i, v, label in distinct]
    assert found == brute_negatives(held, set(range(11)))


def test_boxes_bound_their_rows():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-300, 300, (5000, 12)), rng.integers(-300, 300, (4, 12))
    x = x[negatives.leaves(x.astype(np.int32))]
    levels = negatives.Tree(x).levels
    scores = q @ x.T
    for depth, (low, high) in enumerate(levels):
        least, largest = negatives.intervals(q, low, high)
        run = negatives.LEAF * negatives.FAN ** depth
        for box in range(len(low)):
            inside = scores[:, box * run:(box + 1) * run]
            assert (least[:, box] <= inside.min(axis=1)).all() and (largest[:, box] >= inside.max(axis=1)).all()
    assert len(levels[-1][0]) == 1


def test_boxes_outside_the_window_are_not_opened():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(64, 1, 8)) * 500 + rng.normal(size=(64, 64, 8)) * 5).astype(np.int64).reshape(-1, 8)
    q = x[:1]
    scores = (x @ q[0])
    levels = [(lo[0].tolist(), hi[0].tolist()) for lo, hi in (
        negatives.intervals(q, low, high) for low, high in negatives.Tree(x).levels)]
    opened = []

    def score(a, b):
        opened.append(a)
        return scores[a:b]

    top = int(scores.max())
    best = negatives.best_first(levels, score, list(range(len(x))), [(top // 2, top * 95 // 100)], 3)[0]
    brute = sorted((-int(s), i) for i, s in enumerate(scores) if top // 2 <= s <= top * 95 // 100)[:3]
    assert best == brute and len(opened) < len(levels[0][0]) / 2
