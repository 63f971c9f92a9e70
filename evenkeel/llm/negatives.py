"""Hard negatives for contrastive training, by R-trees packed with sort-tile-recursive.

Vectors of whole numbers are dealt to tiles: slabs of one coordinate, cut into
tiles of another, by cuts of a bounded sample. A tile's rows, in chunks of
bounded size, become one tree: rows are sorted and tiled again in a task, leaf
by leaf, and nodes are packed into nodes. A tree holds rows of one label.

A node's box gives each coordinate an interval, and the anchor's component
times that interval bounds the coordinate's share of the inner product; the
shares add up to the least and the largest score in the box. A best-first queue
opens the box with the largest score first. Boxes outside the wanted score
windows, or strictly below the worst row kept, are never opened. The same test
on the roots decides which trees an anchor visits at all; each anchor first visits
the one with the largest score, whose worst row kept narrows its windows.
"""

from __future__ import annotations

import collections
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.vectors import LIMIT, SCALE, finite, lists, matrix, whole
from evenkeel.sources.staging import staged

POSITIVES, NEGATIVES = 5, 3
# Rows of a leaf, nodes of a node, integers of a tree, rows of a tree at most, anchors of a block, roots of a block.
LEAF, FAN, TREE_VALUES, TREE_ROWS, ANCHORS, ROOTS = 128, 16, 1 << 18, 4_096, 512, 256
# Vectors that the cuts are fitted on.
SAMPLE = 50_000
# Beyond this, sums of products are not exact in doubles.
EXACT = float(1 << 53)
# A window that no score is outside of.
ANY = 1 << 62

ROWS = "vec_id bigint, label bigint, dim int, vector array<int>, tile int"
TREES = ("label bigint, dim int, tile int, chunk int, ids array<bigint>, vectors binary, "
         "low array<int>, high array<int>")
MET = ("tree bigint, block int, vec_id bigint, anchor bigint, vector array<int>, least array<bigint>, "
       "most array<bigint>")
FOUND = "anchor_id bigint, anchor bigint, window int, vec_id bigint, score bigint"


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, least: int = 50, most: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` has vec_id, embedding and label, `anchors` some of the same rows.
    Scores are inner products of floor(256 * component), held within plus and
    minus 2 ** 26. An anchor's positives are its best rows of the same label,
    its negatives the best ones of other labels between `least` and `most` per
    cent of the positive's score; ties go to the smaller vec_id. Rows without
    vec_id, label or vector, or with a null or non-finite component, take no
    part; rows of another dimension do not meet. A row that is repeated whole
    is one; no row of the anchor's vec_id is its positive, and rows that share
    a vec_id are otherwise rows of their own. Exact; runs jobs when called; no
    rows give no rows.
    """
    trees = packed(vectors)
    asked = staged(_asked(anchors), "anchors")
    best = staged(_best(trees, asked, positives, True).select(
        "anchor_id", "anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    lowest, highest = _share("positive_score", least, 99), _share("positive_score", most, 0)
    windows = best.groupBy("anchor_id", "anchor").agg(F.sort_array(F.collect_list(
        F.struct("place", lowest.alias("least"), highest.alias("most")))).alias("windows"))
    wanted = asked.drop("least", "most").join(windows.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "anchor"])
    wanted = staged(wanted.withColumn("least", F.col("windows.least")).withColumn("most", F.col("windows.most"))
                    .drop("windows"), "wanted")
    found = _best(trees, wanted, negatives, False).select(
        "anchor_id", "anchor", (F.col("window") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return found.join(best, ["anchor_id", "anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _share(score: str, percent: int, more: int) -> Column:
    """(percent * score + more) / 100, rounded down, in whole numbers that do not overflow."""
    rest = F.pmod(F.col(score), F.lit(100))
    whole_part = F.expr(f"({score} - pmod({score}, 100)) div 100")
    return whole_part * percent + F.floor((rest * percent + more) / 100).cast("bigint")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding, dim) of the rows that take part, each once."""
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    return rows.groupBy("vec_id", "label", "embedding").agg(F.size("embedding").alias("dim"))


def _integers(embedding: str) -> Column:
    held = F.lit(float(LIMIT))
    return F.transform(embedding, lambda x: F.floor(
        F.greatest(F.least(x.cast("double") * SCALE, held), -held)).cast("int"))


def _asked(anchors: DataFrame) -> DataFrame:
    """Anchors with one window that takes any score."""
    rows = usable(anchors)
    return rows.select("vec_id", "label", "dim", _integers("embedding").alias("vector"),
                       F.xxhash64("label", "embedding").alias("anchor"),
                       F.array(F.lit(-ANY)).alias("least"), F.array(F.lit(ANY)).alias("most"))


# Packing


def packed(vectors: DataFrame) -> DataFrame:
    """A row per tree: its ids, its vectors leaf by leaf, and the box of its root."""
    rows = staged(_tiled(staged(usable(vectors), "distinct-vectors")), "tiled-vectors")
    key = ["label", "dim", "tile"]
    limit = F.greatest(F.lit(LEAF), F.least(F.lit(TREE_ROWS), F.floor(TREE_VALUES / F.greatest("dim", F.lit(1)))))
    sizes = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.max(limit)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("vec_id", "vector"), F.col("chunks")).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        x = matrix(table.column("vector")).astype(np.int32)
        order = leaves(x)
        x = x[order]
        first = [table.column(name)[:1].combine_chunks() for name in (*key, "chunk")]
        ids = pa.array([table.column("vec_id").to_numpy()[order].tolist()], pa.list_(pa.int64()))
        box = [lists(edge[None], pa.int32()) for edge in (x.min(axis=0), x.max(axis=0))]
        return pa.table([*first, ids, pa.array([x.tobytes()], pa.binary()), *box],
                        ["label", "dim", "tile", "chunk", "ids", "vectors", "low", "high"])

    trees = rows.join(sizes, key).withColumn("chunk", chunk).groupBy(*key, "chunk").applyInArrow(pack, TREES)
    return staged(trees.withColumn("tree", F.xxhash64("label", "dim", "tile", "chunk")), "trees")


def leaves(x: np.ndarray) -> np.ndarray:
    """Order of the rows in which each run of `LEAF` is a leaf: sorted and tiled by the widest coordinates."""
    if not x.shape[1]:
        return np.arange(len(x))
    spread = np.argsort(-x.var(axis=0), kind="stable")
    return _tiles(x, np.arange(len(x)), spread[:4], LEAF)


def _tiles(x: np.ndarray, rows: np.ndarray, by: np.ndarray, size: int) -> np.ndarray:
    rows = rows[np.argsort(x[rows, by[0]], kind="stable")]
    pages = -(-len(rows) // size)
    if len(by) == 1 or pages <= 1:
        return rows
    slabs = int(np.ceil(pages ** (1 / len(by))))
    step = -(-pages // slabs) * size
    return np.concatenate([_tiles(x, rows[i:i + step], by[1:], size) for i in range(0, len(rows), step)])


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows with their integers and their tile: a slab of one coordinate cut by another."""
    cuts = _cuts(rows)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            labels = batch.column(1).to_numpy()
            for label, dim in sorted(set(zip(labels.tolist(), sizes.tolist(), strict=True))):
                part = batch.take(pa.array(np.flatnonzero((labels == label) & (sizes == dim))))
                x = whole(matrix(part.column(2), dim))
                tiles = _tile_of(x, cuts.get((label, dim)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([dim] * len(x), pa.int32()), lists(x, pa.int32()),
                     pa.array(tiles, pa.int32())], ["vec_id", "label", "dim", "vector", "tile"])

    return rows.select("vec_id", "label", "embedding").mapInArrow(tile, ROWS)


def _tile_of(x: np.ndarray, cuts: tuple | None) -> np.ndarray:
    if cuts is None:
        return np.zeros(len(x), np.int32)
    (first, second), side, slabs, tiles = cuts
    slab = np.searchsorted(slabs, x[:, first], "right")
    out = np.zeros(len(x), np.int32)
    for s, cut in enumerate(tiles):
        inside = slab == s
        out[inside] = s * side + np.searchsorted(cut, x[inside, second], "right")
    return out


def _cuts(rows: DataFrame) -> dict:
    """For each (label, dimension) of a bounded sample: two coordinates, cuts of the first, cuts of the second by slab."""
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    draw = F.pmod(F.xxhash64("vec_id", "embedding", F.lit(29)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.filter(draw * total < SAMPLE).limit(2 * SAMPLE).select("label", "embedding").toArrow()
    if not sample.num_rows:
        return {}
    column = sample.column("embedding").combine_chunks()
    dims, labels = pc.list_value_length(column).to_numpy(), sample.column("label").to_numpy()
    out = {}
    for label, dim in set(zip(labels.tolist(), dims.tolist(), strict=True)):
        inside = np.flatnonzero((labels == label) & (dims == dim))
        x = whole(matrix(column.take(pa.array(inside)), dim))
        trees = len(x) * max(1.0, total / SAMPLE) * max(dim, 1) / TREE_VALUES
        side = int(np.ceil(np.sqrt(trees)))
        if dim < 2 or side < 2:
            continue
        first, second = np.argsort(-x.var(axis=0), kind="stable")[:2]
        share = np.arange(1, side) / side
        slabs = np.unique(np.quantile(x[:, first], share, method="lower"))
        slab = np.searchsorted(slabs, x[:, first], "right")
        tiles = [np.unique(np.quantile(x[slab == s, second], share, method="lower")) if (slab == s).any()
                 else np.zeros(0, np.int64) for s in range(len(slabs) + 1)]
        out[label, dim] = ((first, second), side, slabs, tiles)
    return out


# Searching


def _best(trees: DataFrame, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, anchor, window, rank, vec_id, score): the best k rows of each window over all trees."""
    first = _ranked(_searched(trees, asked, k, same, True), k).filter(F.col("rank") == k)
    worst = first.groupBy(F.col("anchor_id").alias("vec_id"), "anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("worst"))
    raised = F.transform("least", lambda low, i: F.greatest(low, F.try_element_at("worst", i)))
    narrowed = asked.join(worst, ["vec_id", "anchor"], "left").withColumn(
        "least", F.when(F.col("worst").isNull(), F.col("least")).otherwise(raised)).drop("worst")
    return _ranked(_searched(trees, staged(narrowed, "narrowed"), k, same, False), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "anchor", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(trees: DataFrame, asked: DataFrame, k: int, same: bool, first: bool) -> DataFrame:
    """(anchor_id, anchor, window, vec_id, score): the best k of each tree that an anchor visits."""
    met = staged(_met(trees, asked, same, first), "visits")
    keys = staged(met.select("tree", "block").distinct(), "visited-trees")
    visited = trees.select("tree", "ids", "vectors").join(keys, "tree")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right, k, same)

    key = ["tree", "block"]
    return visited.groupBy(*key).cogroup(met.groupBy(*key)).applyInArrow(search, FOUND)


def _met(trees: DataFrame, asked: DataFrame, same: bool, first: bool) -> DataFrame:
    """Which trees an anchor visits, by the boxes of their roots: blocks of anchors meet blocks of roots.

    With `first`, of each block of roots only the one with the largest score.
    """
    counts = [max(1, -(-rows.count() // size)) for rows, size in ((trees, ROOTS), (asked, ANCHORS))]
    group = F.pmod(F.col("tree"), F.lit(counts[0])).cast("int").alias("part")
    block = F.pmod(F.xxhash64("vec_id", "anchor"), F.lit(counts[1])).cast("int").alias("block")

    def every(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    roots = trees.select(group, every(counts[1], "block"), "tree", "label", "dim", "low", "high")
    anchors = asked.select(every(counts[0], "part"), block, "vec_id", "anchor", "label", "dim", "vector", "least", "most")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return _meet(left, right, same, first)

    return roots.groupBy("part", "block").cogroup(anchors.groupBy("part", "block")).applyInArrow(meet, MET)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: by doubles where those hold the sums, else by integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if _exact(a, b):
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles hold all inner products of rows of both."""
    return not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of each anchor in each box: a component's sign says which edge is which."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _product(up, low) + _product(down, high), _product(up, high) + _product(down, low)


def _meet(left: pa.Table, right: pa.Table, same: bool, first: bool) -> pa.Table:
    rows, trees = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    dims = right.column("dim").to_numpy()
    for dim in sorted(set(dims.tolist()) & set(left.column("dim").to_pylist())):
        roots = left.filter(pc.equal(left.column("dim"), dim))
        place = np.flatnonzero(dims == dim)
        part = right.take(pa.array(place))
        x = matrix(part.column("vector"), dim).astype(np.int64)
        low, high = (matrix(roots.column(name), dim).astype(np.int64) for name in ("low", "high"))
        floor, ceiling = intervals(x, low, high)
        visit = part.column("label").to_numpy()[:, None] == roots.column("label").to_numpy()[None]
        visit = visit if same else ~visit
        for i, (least, most) in enumerate(zip(*(part.column(c).to_pylist() for c in ("least", "most")), strict=True)):
            lo, hi = np.array(least, np.int64)[:, None], np.array(most, np.int64)[:, None]
            visit[i] &= ((ceiling[i] >= lo) & (floor[i] <= hi) & (lo <= hi)).any(axis=0)
        if first:
            top = np.where(visit, ceiling, -ANY).argmax(axis=1)
            visit &= np.arange(roots.num_rows) == top[:, None]
        anchor, tree = np.nonzero(visit)
        rows.append(place[anchor])
        trees.append(roots.column("tree").to_numpy()[tree])
    picked = right.take(pa.array(np.concatenate(rows)))
    names = ["block", "vec_id", "anchor", "vector", "least", "most"]
    return pa.table([pa.array(np.concatenate(trees)), *(picked.column(name) for name in names)], ["tree", *names])


class Tree:
    """Levels of boxes over the rows, leaves first; each run of `FAN` boxes is one box of the next level."""

    def __init__(self, x: np.ndarray):
        self.x = x
        low, high = _boxes(x, x, LEAF)
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = _boxes(low, high, FAN)
            self.levels.append((low, high))


def _boxes(low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(low), size)
    return np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0)


def best_first(levels: list[tuple[list, list]], score: Callable[[int, int], np.ndarray], ids: list[int],
               windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each window of scores its best k rows as (-score, id).

    `levels` holds an anchor's least and largest scores of the boxes, leaves
    first; `score(first, last)` gives the scores of rows.
    """
    kept: list[list[tuple[int, int]]] = [[] for _ in windows]
    # What a row needs to be kept: the window's edge, later the worst score kept; a tie may be, by its id.
    needs, edges = [lo for lo, _ in windows], [hi for _, hi in windows]
    floor, ceiling = np.array(needs)[:, None], np.array(edges)[:, None]

    def wanted(least: int, largest: int) -> bool:
        return any(largest >= need and least <= edge and need <= edge for need, edge in zip(needs, edges, strict=True))

    top = len(levels) - 1
    queue = [(-largest, top, node) for node, largest in enumerate(levels[top][1])]
    heapq.heapify(queue)
    while queue:
        _, level, node = heapq.heappop(queue)
        if not wanted(levels[level][0][node], levels[level][1][node]):
            continue
        if level:
            least, largest = levels[level - 1]
            for child in range(node * FAN, min((node + 1) * FAN, len(largest))):
                if wanted(least[child], largest[child]):
                    heapq.heappush(queue, (-largest[child], level - 1, child))
            continue
        found = score(node * LEAF, (node + 1) * LEAF)
        inside = (found >= floor) & (found <= ceiling)
        if not inside.any():
            continue
        for window, place in np.argwhere(inside).tolist():
            best, row = kept[window], (-int(found[place]), ids[node * LEAF + place])
            if len(best) < k or row < best[-1]:
                best.append(row)
                best.sort()
                del best[k:]
                if len(best) == k:
                    needs[window] = floor[window, 0] = max(needs[window], -best[-1][0])
    return kept


def _search(left: pa.Table, right: pa.Table, k: int, same: bool) -> pa.Table:
    out: list[tuple[int, int, int, int, int]] = []
    if left.num_rows and right.num_rows:
        anchors = matrix(right.column("vector")).astype(np.int64)
        ids = left.column("ids")[0].as_py()
        x = np.frombuffer(left.column("vectors")[0].as_py(), np.int32) if anchors.shape[1] else np.zeros(0, np.int32)
        x = x.reshape(len(ids), anchors.shape[1]).astype(np.int64)
        bounds = [intervals(anchors, low, high) for low, high in Tree(x).levels]
        kind = np.float64 if _exact(anchors, x) else np.int64
        rows_of, anchors_of = x.astype(kind), anchors.astype(kind)
        own = collections.Counter(ids) if same else {}
        rows = zip(*(right.column(c).to_pylist() for c in ("vec_id", "anchor", "least", "most")), strict=True)
        for i, (name, key, least, most) in enumerate(rows):
            levels = [(lo[i].tolist(), hi[i].tolist()) for lo, hi in bounds]
            # The anchor's own rows are no positives: one more is kept for each.
            found = best_first(levels, lambda a, b, i=i: rows_of[a:b] @ anchors_of[i], ids,
                               list(zip(least, most, strict=True)), k + own.get(name, 0))
            for window, best in enumerate(found):
                rows_kept = [(-score, row) for score, row in best if not (same and row == name)][:k]
                out += [(name, key, window, row, score) for score, row in rows_kept]
    columns = list(zip(*out, strict=True)) if out else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    ["anchor_id", "anchor", "window", "vec_id", "score"])
