"""Words, hashes, tokens and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import packing, spans, tokens, toxicity
from evenkeel.llm.charmodel import SIZE, CharModel, count_windows
from evenkeel.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["", " ", "one", " two  words\n", None, "É a\tb\x0bc", "x" * 5000, "a b " * 3000, "\n", "end"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=12), st.integers(1, 40))
def test_words_of_slices(texts, limit):
    found, seen = [], 0
    for row, data, offsets in spans.slices(pa.array(texts, pa.string()), limit):
        assert row == seen
        begin, end, first = spans.words(data, offsets)
        for i in range(len(offsets) - 1):
            found.append([data[b:e].tobytes() for b, e in
                          zip(begin[first[i]:first[i + 1]], end[first[i]:first[i + 1]], strict=True)])
        seen += len(offsets) - 1
    assert found == [WORD.findall((t or "").encode()) for t in texts]


def test_equal_words_have_equal_hashes():
    for limit in (16, 1 << 20):
        by = {}
        for _, data, offsets in spans.slices(pa.array(TEXTS + ["b a end one c"]), limit):
            begin, end, _ = spans.words(data, offsets)
            for b, e, h in zip(begin, end, spans.hash_spans(data, begin, end), strict=True):
                by.setdefault(data[b:e].tobytes(), set()).add(int(h))
        assert all(len(h) == 1 for h in by.values())
        assert len(set.union(*by.values())) == len(by)


def test_sums_of_empty_ranges():
    assert spans.sums(np.array([1.0, 2.0, 4.0]), np.array([0, 0, 2, 2, 3, 3])).tolist() == [0, 3, 0, 4, 0]


def _library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def coder():
    names = packing.public_tokenizer()
    return tokens.Encoder(names.vocabulary, names.ranks, names.pattern), _library(names.vocabulary)


def same(coder, texts):
    fast, library = coder
    got = [np.frombuffer(b, "<u4").tolist() for b in fast.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_library(coder):
    same(coder, ["", " ", "a", " a", "a ", "don't stop", "x  y", "x \n y", "a b c", "<|endoftext|> a",
                 "Ünïcödé ßtraße 12 34", "tab\t tab", "\n\n a", "a  b", "it's 'twas ''s", "🙂 🙂🙂", "a\x85 b"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' .,\n\t é1s "), max_size=25), min_size=1, max_size=5))
def test_ids_of_any_white_space(coder, texts):
    same(coder, texts)


def test_known_pieces_start_anew(coder, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 5)
    for texts in (["a b c d e f g"], ["h i j k l m n"], ["a b c", ""], ["o p q r s t u"], ["a b c h i", "b  c"]):
        same(coder, texts)
    assert "b" in coder[0].young and len(coder[0].young) + len(coder[0].old) < 20


def test_an_encoder_is_forgotten():
    names = packing.public_tokenizer()
    first = tokens.encoder(names.vocabulary, names.ranks, names.pattern)
    assert tokens.encoder(names.vocabulary, names.ranks, names.pattern) is first
    tokens.forget()
    assert tokens.encoder(names.vocabulary, names.ranks, names.pattern) is not first


def test_a_task_gives_its_memory_back():
    @spans.lean
    def run(batches):
        for batch in batches:
            spans._power_tables(len(batch))
            yield len(batch)

    assert list(run(iter(["abc", "de"]))) == [3, 2] and not spans._powers


def union_find(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "path", "star"])
def test_components(spark, shape):
    rng = random.Random(5)
    if shape == "random":
        pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    elif shape == "path":
        order = rng.sample(range(60), 60)
        pairs = list(zip(order, order[1:], strict=False))
    else:
        pairs = [(99, i) for i in range(50)]
    frame = spark.createDataFrame(pairs + pairs[:5] + [(None, 1)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(frame).collect()}
    expected = union_find([p for p in pairs if p[0] != p[1]])
    assert found == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_plain_words_and_readings_cost_nothing_twice(monkeypatch):
    assert toxicity.lattice("ab")[0] is toxicity.lattice("cab")[1]
    model = CharModel(np.zeros(SIZE, np.int64))
    assert isinstance(model.cost(0x202020, 0x61), float) and isinstance(model.single[0x61], int)
    decoder = toxicity.Decoder(model)
    monkeypatch.setattr(toxicity, "edges", None)
    assert [decoder.token(t) for t in ("plain", "letter", "éa")] == ["plain", "letter", "éa"]


# Evidence

PATTERN = "the bad idea died; a dead bee did abide. bade added idiot aid beaded " * 3


def small_decoder():
    totals = np.zeros(SIZE, np.int64)
    data = np.frombuffer(PATTERN.encode(), np.uint8)
    count_windows(data, np.array([0, len(data)]), totals)
    return toxicity.Decoder(CharModel(totals))


def plain_top(text, decoder, odds):
    """The three highest log odds of all words that are read, nothing left out."""
    parts, known = text.lower().split(), {f[2:] for f in odds if f.startswith("w:")}
    words = {w for part in parts for w in decoder.token(part).split()}
    for match in toxicity._SPACED.finditer(text.lower()):
        words |= set(decoder.viterbi(match.group()).split())
    for at in range(len(parts)):
        for end in range(at + 1, len(parts)):
            last = parts[end].strip(toxicity._EDGE)
            joined = "".join(parts[at:end]) + last
            if joined in known and decoder.viterbi(" ".join([*parts[at:end], last])) == joined:
                words.add(joined)
            if last != parts[end]:
                break
    found = [max([odds.get(f"w:{w}", 0.0)] + [odds.get(f"{n}:{w[:n]}", 0.0) for n in (4, 5, 6) if len(w) >= n])
             for w in words]
    return (sorted(found, reverse=True) + [0.0] * 3)[:3]


NAMES = st.one_of(st.text("abdei", min_size=1, max_size=8).map("w:".__add__),
                  *(st.text("abdei", min_size=n, max_size=n).map(f"{n}:".__add__) for n in (4, 5, 6)))
PIECES = st.one_of(st.text("abdei", min_size=1, max_size=8), st.text("aabdei1$%*!&.,~²іaé", max_size=8),
                   st.sampled_from(["idiot", "id iot", "iddioott", "bad$$$", "idea%", "b a d", "d\ne\na\nd", "*dead", "!!idea."]))


@settings(max_examples=400, deadline=None)
@given(st.dictionaries(NAMES, st.integers(1, 9).map(float), max_size=12), st.lists(PIECES, max_size=12),
       st.sampled_from([" ", "\n", "  "]), st.integers(0, 6))
def test_evidence_leaves_nothing_out(odds, pieces, blank, whole):
    # Some of the text's own words and beginnings count.
    for piece in filter(None, pieces[:whole]):
        odds = odds | {f"w:{piece}": 5.0, f"w:{piece[:3]}": 2.5} | ({f"4:{piece[:4]}": 1.5} if len(piece) > 3 else {})
    decoder, text = small_decoder(), blank.join(pieces)
    assert toxicity.Evidence(decoder, odds).top(text) == plain_top(text, decoder, odds)


def test_tokens_without_evidence_are_not_decoded(monkeypatch):
    known = toxicity.Evidence(small_decoder(), {"w:idiot": 3.0, "w:abide": 1.0, "4:dead": 2.0, "w:beaded": 2.5})
    monkeypatch.setattr(known.decoder, "decode", None)
    # "ab ide" is below the three that the text has already.
    text = "zachzu% thbleerre, ouinha$$$ idiot beaded deadly ab ide"
    assert known.top(text) == [3.0, 2.5, 2.0]


def test_a_sign_at_the_end_goes_on_from_the_word(monkeypatch):
    decoder, seen, lattice = small_decoder(), [], toxicity.lattice
    monkeypatch.setattr(toxicity, "lattice", lambda text: seen.append(text) or lattice(text))
    assert decoder.token("idea%") == "idea" and seen == ["idea", "%"]
