"""The classifiers against plain versions: dictionaries and loops, a text and a feature at a time."""

import collections
import functools
import itertools
import math
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from evenkeel.llm import charmodel, language, quality, queries, tables, toxicity

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
FULL = 2 ** 64


def documents(spark):
    return [r for r in tables.documents(spark, SMALL).collect()]


def marks(spark, label):
    return {r.doc_id: r[label] for r in tables.labels(spark, SMALL).collect() if r[label] is not None}


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def turn(doc_id, seed):
    """The signed hash of an id and a seed, by which samples are ordered."""
    h = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), h)
    return h - FULL if h >= FULL // 2 else h


def logistic(z):
    return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def spread(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % FULL
    h = (h ^ h >> 27) * 0x94D049BB133111EB % FULL
    return h ^ h >> 31


@functools.cache
def hashed(word):
    return spread(sum((byte + 1) * pow(0x9E3779B97F4A7C15, i, FULL) for i, byte in enumerate(word)) % FULL)


# Quality

def sign(byte):
    char = chr(byte)
    if byte >= 0x80 or "a" <= char <= "z":
        return "a"
    if "A" <= char <= "Z":
        return "A"
    if "0" <= char <= "9":
        return "0"
    return "," if char in ",.;:" else "!"


def ngrams(text):
    """Share of each table place in a text."""
    words = WORD.findall(text.encode())
    lower = [hashed(w.translate(LOWER)) for w in words]
    forms = [hashed("".join(s for s, _ in itertools.groupby(map(sign, w))).encode()) for w in words]
    forms = [int(quality._REPEAT) if i and lower[i] == lower[i - 1] else f for i, f in enumerate(forms)]
    pair = int(quality._PAIR)
    places = []
    for kind, row in ((1, lower), (3, forms)):
        for i, value in enumerate(row):
            both = ((row[i - 1] if i else 0) * pair + value) % FULL
            places += [spread((value + kind * pair) % FULL) >> 64 - quality.BITS,
                       spread((both + (kind + 1) * pair) % FULL) >> 64 - quality.BITS]
    return {p: quality.SCALE * n / len(places) for p, n in collections.Counter(places).items()}


def leader(z, n):
    if abs(z) <= quality.L1:
        return 0.0
    return (math.copysign(quality.L1, z) - z) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)


def regularised(rows):
    """Weights of (features, label) rows after all passes."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    for features, label in rows * quality.EPOCHS:
        x = features | {"bias": 1.0}
        w = {f: leader(z[f], n[f]) for f in x}
        error = logistic(sum(w[f] * v for f, v in x.items())) - label
        for f, v in x.items():
            g = error * v
            z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / quality.ALPHA * w[f]
            n[f] += g * g
    return {f: leader(z[f], n[f]) for f in z}


def test_quality_equals_a_plain_version(spark):
    docs = documents(spark)
    shares = {r.doc_id: ngrams(r.text or "") for r in docs}
    learned = {i: y for i, y in marks(spark, "quality").items() if fold(i, 3) != 1 and i in shares}
    weights = regularised([(shares[i], learned[i]) for i in sorted(learned, key=lambda i: turn(i, 7))])
    found = {r.doc_id: r for r in queries.op1_quality_classifier(spark, SMALL).collect()}
    assert found.keys() == shares.keys() and len(learned) < quality.MAX_TRAINING
    for i, x in shares.items():
        z = weights["bias"] + sum(weights.get(p, 0.0) * v for p, v in x.items())
        assert found[i].score == pytest.approx(logistic(z), abs=1e-4)
        assert found[i].predicted == (found[i].score >= 0.5) and found[i].held_out == (fold(i, 3) == 1)


# Language

def windows(text):
    """Share of each table place in a text: windows of two to four bytes that touch a letter at their end."""
    kept = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in text.lower().encode())
    padded = b"   " + kept + b"   "
    places = []
    for end in range(3, len(padded)):
        if padded[end - 1:end + 1] == b"  ":
            continue
        for factor, size in zip(language._TURN, language.ORDERS, strict=True):
            value = int.from_bytes(padded[end - size + 1:end + 1], "big")
            places.append((value * factor + factor % 65521) % 2 ** 32 >> 32 - language.BITS)
    return {p: language.SCALE * n / len(places) for p, n in collections.Counter(places).items()}


def machine(rows):
    """Weights and bias of (features, +1 or -1) rows by coordinate ascent on the dual."""
    w, bias, dual = collections.defaultdict(float), 0.0, [0.0] * len(rows)
    for _ in range(language.PASSES):
        for i, (x, y) in enumerate(rows):
            margin = y * (sum(w[p] * v for p, v in x.items()) + bias)
            step = dual[i] - (margin - 1) / (sum(v * v for v in x.values()) + 1)
            moved = min(max(step, 0.0), language.COST) - dual[i]
            for p, v in x.items():
                w[p] += moved * y * v
            bias += moved * y
            dual[i] += moved
    return w, bias


def duel_of(rows, a, b):
    return machine([(x, 1 if name == a else -1) for x, name in rows if name in (a, b)])


def winner(x, names, machines):
    """The name that wins most duels, and its closest margin."""
    won, total, least = collections.Counter(), collections.Counter(), {n: math.inf for n in names}
    for a, b in itertools.combinations(names, 2):
        w, bias = machines[a, b]
        m = bias + sum(w.get(p, 0.0) * v for p, v in x.items())
        for name, own in ((a, m), (b, -m)):
            won[name] += own > 0
            total[name] += own
            least[name] = min(least[name], own)
    best = max(names, key=lambda n: (won[n], total[n]))
    return best, least[best]


def test_language_equals_a_plain_version(spark):
    docs = documents(spark)
    shares = {r.doc_id: windows(r.text or "") for r in docs}
    learned = sorted((r for r in docs if r.lang and r.text is not None and fold(r.doc_id, 4) != 2),
                     key=lambda r: turn(r.doc_id, 11))
    by_language = [(shares[r.doc_id], r.lang) for r in learned]
    by_family = [(x, language.family(name)) for x, name in by_language]
    families = collections.defaultdict(list)
    for name in sorted({r.lang for r in learned}):
        families[language.family(name)].append(name)
    machines = {pair: duel_of(by_family, *pair) for pair in itertools.combinations(sorted(families), 2)}
    for names in families.values():
        machines |= {pair: duel_of(by_language, *pair) for pair in itertools.combinations(names, 2)}
    found = {r.doc_id: r for r in queries.op5_language_id(spark, SMALL).collect()}
    assert found.keys() == shares.keys() and max(collections.Counter(n for _, n in by_language).values()) < 1_500
    for r in docs:
        row, x = found[r.doc_id], shares[r.doc_id]
        if not any(map(str.isalpha, r.text or "")):
            assert (row.lang_pred, row.score) == (language.UNKNOWN, 0)
            continue
        group, sure = winner(x, sorted(families), machines)
        name, inside = winner(x, families[group], machines)
        assert row.lang_pred == name
        assert row.score == pytest.approx(logistic(language.STEEP * min(sure, inside)), abs=1e-3)


# Toxicity

def character_counts(texts):
    """Counts of all windows of two to four bytes, by their place in the model's tables."""
    counts = collections.Counter()
    for text in texts:
        kept = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in text.lower().encode())
        padded = b"   " + kept + b"   "
        for end in range(3, len(padded)):
            if padded[end - 1:end + 1] != b"  ":
                for size in (2, 3, 4):
                    counts[charmodel.place(int.from_bytes(padded[end - size + 1:end + 1], "big"), size)] += 1
    return counts


def word_odds(toxic, clean, all_toxic, all_clean):
    """Log odds of a feature, lowered by two standard errors; zero if fewer than two toxic texts have it."""
    a, b = toxic + 0.5, clean + 0.5
    odds = math.log(a / (all_toxic + 1) / (b / (all_clean + 1))) - 2 * math.sqrt(1 / a + 1 / b)
    return odds if toxic >= 2 else 0.0


def begins(word):
    return {f"w:{word}", *(f"{n}:{word[:n]}" for n in (4, 5, 6) if len(word) >= n)}


def readings(text, decoder):
    """The distinct words of a text as the decoder reads them, word by word."""
    lowered = text.lower()
    found = {w for token in lowered.split() for w in decoder.token(token).split()}
    for match in toxicity.spaced(lowered):
        found |= set(decoder.viterbi(match.group()).split())
    return found


def in_chunks(text, known, decoder):
    """Known words that two or more neighbouring tokens make up, all but the last without signs at an edge."""
    parts = text.lower().split()
    most = max(map(len, known), default=0)
    for at, end in ((i, i + n) for n in range(2, most + 1) for i in range(len(parts) - n + 1)):
        if any(p.strip(toxicity._EDGE) != p for p in parts[at + 1:end - 1]):
            continue
        row = [*parts[at:end - 1], parts[end - 1].strip(toxicity._EDGE)]
        if "".join(row) in known and all(row) and decoder.viterbi(" ".join(row)) == "".join(row):
            yield "".join(row)


def highest(values):
    return (sorted((v for v in values if v > 0), reverse=True) + [0.0] * 3)[:3]


def test_toxicity_equals_a_plain_version(spark):
    docs = {r.doc_id: r.text or "" for r in documents(spark)}
    totals = charmodel.count(tables.documents(spark, SMALL))
    counts = character_counts(docs.values())
    assert {i: n for i, n in enumerate(totals.tolist()) if n} == counts
    decoder = toxicity.Decoder(charmodel.CharModel(totals))

    learned = {i: y for i, y in marks(spark, "toxic").items() if fold(i, 5) and i in docs}
    sizes = collections.Counter(learned.values())
    words = {i: readings(docs[i], decoder) for i in docs}
    has = {i: set().union(*map(begins, words[i])) for i in learned}
    texts = {y: collections.Counter(f for i in learned if learned[i] == y for f in has[i]) for y in (0, 1)}
    odds = {f: word_odds(n, texts[0][f], sizes[1], sizes[0]) for f, n in texts[1].items()}
    odds = {f: v for f, v in odds.items() if v > 0}
    sample = tables.training_rows(tables.documents(spark, SMALL).select("doc_id", "text"),
                                  tables.labels(spark, SMALL).filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0),
                                  "toxic", toxicity.MAX_TRAINING)
    model = toxicity.fit(sample, totals)
    assert model.odds == pytest.approx(odds)

    # The weights are where the penalised likelihood is flat; a text's own share is not in its odds.
    slope = [0.05 * w for w in model.weights]
    for i, y in learned.items():
        own = [max((word_odds(texts[1][f] - (y == 1), texts[0][f] - (y == 0), sizes[1] - (y == 1), sizes[0] - (y == 0))
                    for f in begins(word) if f in odds), default=0.0) for word in words[i]]
        x = [1.0, *highest(own)]
        error = logistic(sum(w * v for w, v in zip(model.weights, x, strict=True))) - y
        slope = [s + error * v for s, v in zip(slope, x, strict=True)]
    assert slope == pytest.approx([0.0] * 4, abs=1e-6)

    known = {f[2:] for f in odds if f.startswith("w:")}
    found = {r.doc_id: r for r in queries.op2_toxicity(spark, SMALL).collect()}
    assert found.keys() == docs.keys()
    for i, text in docs.items():
        all_words = words[i] | set(in_chunks(text, known, decoder))
        top = highest([max(odds.get(f, 0.0) for f in begins(word)) for word in all_words])
        score = logistic(sum(w * v for w, v in zip(model.weights, [1.0, *top], strict=True)))
        assert found[i].score == pytest.approx(score, abs=1e-9)
