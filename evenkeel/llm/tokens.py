"""Token ids of whole texts with a byte-level BPE vocabulary.

The two files hold one vocabulary. Ids come as packed little-endian unsigned
32-bit numbers. A piece of text between single spaces keeps its ids wherever
it stands, so each distinct piece of a batch is encoded once, and a text's ids
are gathered by the numbers of its pieces. Texts with other runs of white space
at a piece's edge are encoded whole.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces of a generation: a worker keeps the last two, so frequent pieces stay known.
KEPT, KEPT_CHARS = 50_000, 4_000_000


class Encoder:
    """`vocabulary`: the tokenizer's JSON file; `ranks`: the same as base64 tokens and ranks."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)
        self.vocabulary, self.special = vocabulary, _special(vocabulary)
        # Ids of pieces behind a space; None for pieces that do not stand alone.
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.chars = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = parts.offsets.to_numpy()
        named = parts.flatten().dictionary_encode()
        codes = named.indices.to_numpy()
        # A text's first piece has no space before it.
        behind = np.ones(len(codes), bool)
        behind[ends[:-1]] = False
        used = np.unique(codes[behind])
        known = self._known(named.dictionary.take(pa.array(used)).to_pylist())
        place = np.searchsorted(used, codes.clip(max=used[-1] if len(used) else 0))
        lone = np.array([ids is None for ids in known], bool) if known else np.ones(1, bool)
        whole = np.add.reduceat(lone[place.clip(max=len(lone) - 1)] & behind, ends[:-1]) > 0
        raw = b"".join(ids or b"" for ids in known)
        sizes = np.array([len(ids or b"") for ids in known] or [0], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        first = named.dictionary.take(pa.array(codes[ends[:-1]])).to_pylist()
        out = []
        for i, text in enumerate(texts):
            begin, end = ends[i] + 1, ends[i + 1]
            if any(s in text for s in self.special):
                out.append(pack(_library(self.vocabulary).encode(text, add_special_tokens=False).ids))
            elif whole[i] or begin == end or not first[i] or first[i][-1].isspace():
                out.append(pack(self.fast.encode_ordinary(text)))
            else:
                rest = place[begin:end]
                out.append(pack(self.fast.encode_ordinary(first[i])) + _gathered(raw, starts[rest], sizes[rest]))
        return out

    def _known(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of each piece, by both generations; what neither has is encoded in one call."""
        if len(self.young) > KEPT or self.chars > KEPT_CHARS:
            self.old, self.young, self.chars = self.young, {}, 0
        fresh = []
        for piece in pieces:
            if piece not in self.young:
                self.chars += len(piece)
                if piece in self.old:
                    self.young[piece] = self.old[piece]
                else:
                    fresh.append(piece)
        self._learn(fresh)
        return [self.young[piece] for piece in pieces]

    def _learn(self, pieces: list[str]) -> None:
        plain = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace()]
        self.young.update(dict.fromkeys(pieces))
        ids = np.array(self.fast.encode_ordinary("".join(" " + p for p in plain)), np.uint32)
        ends = np.cumsum([len(p.encode()) + 1 for p in plain], dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        raw, start = ids.astype("<u4").tobytes(), 0
        for piece, cut in zip(plain, (4 * cuts).tolist(), strict=True):
            self.young[piece] = raw[start:cut]
            start = cut


def _gathered(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """The ranges of packed ids, one behind the other."""
    ids = np.frombuffer(raw, "<u4")
    counts = sizes // 4
    shift = starts // 4 - np.concatenate([[0], np.cumsum(counts)[:-1]])
    return ids[np.repeat(shift, counts) + np.arange(int(counts.sum()))].tobytes()


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _library(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def _special(vocabulary: str) -> tuple[str, ...]:
    """Strings that the vocabulary's file adds to its pieces; the library is loaded for texts with one only."""
    with open(vocabulary, encoding="utf-8") as file:
        return tuple(token["content"] for token in json.load(file).get("added_tokens", ()))


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """One encoder per Python worker, until `forget`."""
    return Encoder(vocabulary, ranks, pattern)


def forget() -> None:
    """Drop encoders and libraries, so that a worker that Spark keeps for other stages does not hold them."""
    encoder.cache_clear()
    _library.cache_clear()
