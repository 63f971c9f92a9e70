"""Largest inner products by collision counting over single projections.

Vectors are dealt to segments of bounded size. In a segment each vector gets a
further component that brings all to one length, so that the largest inner
product is the smallest distance. Each of `LINES` random lines is a hash: its
sorted array holds the segment's projections, and a query's window on it is
centred on the query's own projection. First windows hold a share of the
segment; the vectors met most often are verified with their exact products, and
the k-th best of them tells how far the k nearest can be. The windows are widened
to that half width (virtual rehashing: only the new flanks are counted), and
every vector met in `needed` windows is verified.

A vector within distance R falls in a window of half width R on one line with
probability 0.683. So a vector that belongs to the k nearest is missed with
a chance of one in twenty if it is as far as the windows reach, and hardly ever
if it is nearer, whatever the data are. With fewer than k vectors at first the
windows cover the segment and all of it is verified.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.vectors import finite, matrix
from evenkeel.sources.staging import staged

NEAREST, LINES, SEED = 20, 32, 11
# Vectors of a segment and queries of a block, as dealt by hash.
SEGMENT, BLOCK = 8_192, 1_024
# Probability of a collision on one line at the window's half width; standard deviations below the mean that are let in.
COLLISION, ROOM = 0.6826894921370859, 1.65
# Share of a segment that the first windows hold, in vectors at least; the most met that are verified, times k.
FIRST, FIRST_ROWS, PROBES = 1 / 16, 32, 4
# Bound of a product's rounding, as a share of the lengths.
ROUNDING = 1e-12

FOUND = "query_id bigint, query bigint, vec_id bigint, score double"


def search(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, lines: int = LINES) -> DataFrame:
    """(query_id, rank, vec_id, score): the `nearest` rows of `vectors` with the largest inner products.

    Both have vec_id and embedding; other columns are ignored. Rows that are
    null, zero, or hold a null or non-finite component take no part, nor do
    rows without vec_id. A row repeated with its vec_id is one; a vec_id with
    several vectors is as many candidates, and as many queries, each with
    ranks of its own. No candidate has its query's vec_id, or another
    dimension. Equal scores go by vec_id. Scores are in double precision.
    Approximate, see the module; runs jobs when called; no rows give no rows.
    """
    rows = staged(_usable(vectors).groupBy("vec_id", "embedding").agg(F.size("embedding").alias("dim")), "candidates")
    asked = staged(_usable(queries).groupBy("vec_id", "embedding").agg(F.size("embedding").alias("dim")), "queries")
    segment = _dealt(rows, SEGMENT, "segment", "segments")
    block = _dealt(asked, BLOCK, "block", "blocks")
    sizes = segment.groupBy("dim").agg(F.first("segments").alias("segments"))
    blocks = block.groupBy("dim").agg(F.first("blocks").alias("blocks"))

    def every(count: str, name: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)

    # The stated queries meet all rows in blocks: a group holds one block and one segment.
    key = ["dim", "segment", "block"]
    met = segment.join(blocks, "dim").select("dim", "segment", every("blocks", "block"), "vec_id", "embedding")
    ask = block.join(sizes, "dim").select("dim", every("segments", "segment"), "block", "vec_id", "embedding")

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        return _find(left, right, nearest, lines)

    found = met.groupBy(*key).cogroup(ask.groupBy(*key)).applyInArrow(find, FOUND)
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
            .select("query_id", "rank", "vec_id", "score"))


def _usable(vectors: DataFrame) -> DataFrame:
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & finite("embedding") & F.coalesce(some, F.lit(False)))


def _dealt(rows: DataFrame, size: int, name: str, count: str) -> DataFrame:
    """Rows with a number from 0 to `count` - 1, so that about `size` rows of a dimension share one."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(count))
    spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.col(count)).cast("int")
    return rows.join(counts, "dim").withColumn(name, spread)


@dataclass
class Segment:
    """Vectors with their sorted projections on each line."""

    ids: np.ndarray
    x: np.ndarray
    length: float
    order: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, x: np.ndarray, lines: np.ndarray) -> Segment:
        scale = np.abs(x).max()
        squares = ((x / scale) ** 2).sum(axis=1)
        length = float(np.sqrt(squares.max()))
        rest = np.sqrt(np.maximum(length ** 2 - squares, 0))
        # In units of the longest vector.
        projected = ((x / scale) @ lines[:-1] + rest[:, None] * lines[-1]).T / length
        order = np.argsort(projected, axis=1, kind="stable")
        return cls(ids, x, length * scale, order, np.take_along_axis(projected, order, axis=1))


def random_lines(dim: int, lines: int) -> np.ndarray:
    """A direction per column; the same ones in every task."""
    return np.random.default_rng([SEED, dim]).normal(size=(dim + 1, lines))


def needed(lines: int) -> int:
    """Collisions asked of a candidate."""
    return max(1, int(lines * COLLISION - ROOM * np.sqrt(lines * COLLISION * (1 - COLLISION))))


def nearest_in(segment: Segment, query: np.ndarray, own: int, projected: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k largest inner products found in a segment, best first."""
    n = segment.values.shape[1]
    least, size = needed(len(segment.values)), float(np.linalg.norm(query))
    unseen = segment.ids != own
    verified, scores, half = np.zeros(0, np.int64), np.zeros(0), np.inf

    def verify(fresh: np.ndarray) -> None:
        """Keep what may be among the best, and learn how far the k-th of it is."""
        nonlocal verified, scores, half
        unseen[fresh] = False
        verified, scores = np.append(verified, fresh), np.append(scores, segment.x[fresh] @ query)
        if len(verified) >= k:
            # With room for the products' rounding.
            worst = np.partition(scores, -k)[-k] - ROUNDING * size * segment.length
            close = scores >= worst
            verified, scores = verified[close], scores[close]
            # Distance of query and lengthened vector, in units of the longest.
            half = np.sqrt(max(0.0, 2 - 2 * worst / (size * segment.length)))

    middle = np.array([v.searchsorted(p) for v, p in zip(segment.values, projected, strict=True)])
    reach = max(FIRST_ROWS, int(n * FIRST)) // 2
    low, high = np.maximum(middle - reach, 0), np.minimum(middle + reach, n)
    counts = np.bincount(np.concatenate([o[a:b] for o, a, b in zip(segment.order, low, high, strict=True)]), minlength=n)
    # The vectors met most often tell how wide the windows have to be.
    probes = np.argsort(-counts, kind="stable")[:PROBES * k]
    verify(probes[unseen[probes]])
    starts = [v.searchsorted(p - half, "left") for v, p in zip(segment.values, projected, strict=True)]
    ends = [v.searchsorted(p + half, "right") for v, p in zip(segment.values, projected, strict=True)]
    lines = list(zip(segment.order, starts, low, high, ends, strict=True))
    flanks = [o[a:b] for o, a, b, _, _ in lines if a < b] + [o[a:b] for o, _, _, a, b in lines if a < b]
    if flanks:
        counts += np.bincount(np.concatenate(flanks), minlength=n)
    verify(np.flatnonzero((counts >= least) & unseen))
    # A product that does not depend on where the vector stands: equal vectors have equal scores.
    scores = (segment.x[verified] * query).sum(axis=1)
    best = np.lexsort((segment.ids[verified], -scores))[:k]
    return verified[best], scores[best]


def _find(left: pa.Table, right: pa.Table, k: int, lines: int) -> pa.Table:
    queries, out = right.num_rows, []
    if left.num_rows and queries:
        table = left.sort_by("vec_id")
        x = matrix(table.column("embedding"))
        direction = random_lines(x.shape[1], lines)
        segment = Segment.of(table.column("vec_id").to_numpy(), x, direction)
        asked = matrix(right.column("embedding"))
        top = np.abs(asked).max(axis=1, keepdims=True)
        unit = asked / top
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        projected = unit @ direction[:-1]
        for i, own in enumerate(right.column("vec_id").to_pylist()):
            place, score = nearest_in(segment, asked[i], own, projected[i], k)
            out.append((np.full(len(place), own), np.full(len(place), i), segment.ids[place], score))
    ids, number, found, score = (np.concatenate([o[c] for o in out]) if out else np.zeros(0) for c in range(4))
    keys = _keys(right)
    return pa.table([pa.array(ids.astype(np.int64)), pa.array(keys[number.astype(np.int64)], pa.int64()),
                     pa.array(found.astype(np.int64)), pa.array(score, pa.float64())],
                    ["query_id", "query", "vec_id", "score"])


def _keys(table: pa.Table) -> np.ndarray:
    """A number per vector, to keep queries apart that share a vec_id."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(np.float32(v).tobytes()) >> 1 for v in
                     table.column("embedding").to_pylist()], np.int64)
