"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them.

Vectors are compared only inside a group (an equal label and dimension). Each
group is cut into cells by centres fitted on a bounded sample. A vector is at
home in its nearest cell and visits those whose border is close to it, where it
meets the vectors at home there. Large cells are cut into blocks; a task holds
two blocks and returns a row per vector, never a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.sources.staging import staged

THRESHOLD = 0.98
# Vectors that the centres are fitted on, vectors a cell is meant for, and cells at most.
SAMPLE, CELL, MAX_CELLS = 50_000, 1_024, 4_096
ROUNDS = 8
# Room for rounding where a vector's distance from a border is compared.
ROUNDING = 1e-6
# Rows of a block, and rows of a product that are held at a time.
BLOCK, TILE = 4_096, 1_024

CENTRES = "label int, dim int, cell int, centre array<double>"
PLACED = ("label int, dim int, cell int, home int, visits array<int>, id bigint, copies bigint, "
          "embedding array<float>")
LINKED = "id bigint, links bigint, root bigint"


def margin_of(threshold: float) -> float:
    """How near a cell's border a vector visits the cell so that no pair is lost.

    Unit vectors at the threshold are sqrt(2 - 2 * threshold) apart. If their
    homes differ, they lie on the two sides of the border between these, so one
    of them is within half that of it and visits the other's home.
    """
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) / 2 + ROUNDING


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one vector of each component is kept, that of the smallest vec_id.

    `vectors` has vec_id, embedding and label. Vectors link inside a label at a
    cosine of `threshold` or more, in double precision. Those without a label,
    null, zero, or with a component that is null or not finite link with
    nothing, nor do vectors of another dimension. Copies of a vector are one
    row of every step and count as links of each other. A row whose vec_id is
    null is not compared and not kept; rows that repeat a vec_id count as
    different vectors. Runs jobs when called; no rows give no rows.
    """
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("int").alias("label"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~bad & some, F.lit(False))
    marked = rows.withColumn("usable", usable)
    distinct = staged(marked.filter("usable").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    links = staged(_linked(_placed(distinct, margin_of(threshold)), threshold), "vector-links")
    joined = components(links.select("id", "root"), "id", "root")
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = staged(
        distinct.join(counts, "id", "left").join(joined, F.col("id") == F.col("node"), "left").select(
            "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id")), "vector-groups")
    out = marked.join(known, ["label", "embedding"], "left")
    alone = ~F.col("usable")
    return out.select("vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
                      F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
                      ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def centres(distinct: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Unit centres of each (label, dimension), fitted on about `SAMPLE` vectors chosen by a hash of their id."""
    sizes = distinct.groupBy("label", F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = F.greatest(F.lit(1), F.least(F.ceil(F.col("n") / CELL), F.ceil(MAX_CELLS * F.col("n") / max(total, 1))))
    draw = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) / (1 << 30)
    sample = (distinct.filter(draw * total < SAMPLE).withColumn("dim", F.size("embedding"))
              .join(F.broadcast(sizes.select("label", "dim", cells.cast("int").alias("cells"))), ["label", "dim"]))

    def fit(table: pa.Table) -> pa.Table:
        x = _unit(_matrix(table.column("embedding")))
        found = spherical_kmeans(x[np.argsort(table.column("id").to_numpy())], table.column("cells")[0].as_py())
        label, dim = table.column("label")[0].as_py(), table.column("dim")[0].as_py()
        size = len(found)
        return pa.table([pa.array([label] * size, pa.int32()), pa.array([dim] * size, pa.int32()),
                         pa.array(range(size), pa.int32()), pa.array(list(found), pa.list_(pa.float64()))],
                        ["label", "dim", "cell", "centre"])

    rows = sample.groupBy("label", "dim").applyInArrow(fit, CENTRES).collect()
    out: dict[tuple[int, int], list] = {}
    for row in sorted(rows, key=lambda r: (r["label"], r["dim"], r["cell"])):
        out.setdefault((row["label"], row["dim"]), []).append(row["centre"])
    return {key: np.array(value) for key, value in out.items()}


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres after `rounds` of assignment by cosine; the first ones are spread over the rows."""
    centre = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[i:i + TILE] @ centre.T).argmax(axis=1) for i in range(0, len(x), TILE)])
        for c in range(len(centre)):
            total = x[home == c].sum(axis=0)
            size = np.linalg.norm(total)
            if size > 0:
                centre[c] = total / size
    return centre


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _placed(distinct: DataFrame, margin: float) -> DataFrame:
    """A row for each vector in its home cell and in each cell that it visits."""
    known = centres(distinct)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(3)).to_pylist()
            groups: dict[tuple[int, int], list[int]] = {}
            for i, key in enumerate(zip(batch.column(0).to_pylist(), sizes, strict=True)):
                groups.setdefault(key, []).append(i)
            for (label, dim), rows in groups.items():
                for at in range(0, len(rows), TILE):
                    yield _place(batch.take(rows[at:at + TILE]), label, dim, known.get((label, dim)), margin)

    return distinct.select("label", "id", "copies", "embedding").mapInArrow(place, PLACED)


def _place(rows: pa.RecordBatch, label: int, dim: int, centre: np.ndarray | None, margin: float) -> pa.RecordBatch:
    x = _unit(_matrix(rows.column(3)))
    centre = x[:1] if centre is None else centre
    near = x @ centre.T
    home = near.argmax(axis=1)
    gap = near[np.arange(len(x)), home][:, None] - near
    border = np.linalg.norm(centre[home][:, None] - centre[None], axis=2) if len(centre) < 64 else np.sqrt(
        np.maximum(2 - 2 * centre[home] @ centre.T, 0))
    inside = gap <= margin * border
    inside[np.arange(len(x)), home] = True
    row, cell = np.nonzero(inside)
    visits = [np.flatnonzero(v).tolist() for v in inside]
    picked = rows.take(pa.array(row))
    size = len(row)
    return pa.RecordBatch.from_arrays(
        [picked.column(0), pa.array([dim] * size, pa.int32()), pa.array(cell.astype(np.int32)),
         pa.array(home[row].astype(np.int32)), pa.array([visits[i] for i in row], pa.list_(pa.int32())),
         picked.column(1), picked.column(2), picked.column(3)],
        [part.split()[0] for part in PLACED.split(", ")])


def _linked(placed: DataFrame, threshold: float) -> DataFrame:
    """(id, links, root) of vectors with links in a pair of blocks; root ties the linked ones together."""
    placed = staged(placed, "vector-cells")
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = placed.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Block b meets every block: as the first of the pairs (b, b..), as the second of (..b, b).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("other", other).select(
        *cell, "home", "visits", "id", "copies", "embedding", "block",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, threshold)

    return dealt.groupBy(*cell, "one", "two").applyInArrow(compare, LINKED)


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    table = table.sort_by("id")
    x = _matrix(table.column("embedding"))
    norm = np.linalg.norm(x, axis=1)
    ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
    home, block = table.column("home").to_numpy(), table.column("block").to_numpy()
    cell, one, two = (table.column(c)[0].as_py() for c in ("cell", "one", "two"))
    # Which of the homes met here a vector visits.
    homes, home_at = np.unique(home, return_inverse=True)
    visits = np.zeros((len(ids), len(homes)), bool)
    lists = table.column("visits").combine_chunks()
    row = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
    visited = lists.flatten().to_numpy()
    place = np.searchsorted(homes, visited).clip(max=len(homes) - 1)
    met = homes[place] == visited
    visits[row[met], place[met]] = True
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for at in range(0, len(ids), TILE):
        cosine = (x[at:at + TILE] @ x[at:].T) / (norm[at:at + TILE, None] * norm[None, at:])
        i, j = np.nonzero(cosine >= threshold)
        i, j = i + at, j + at
        # Each pair once: in this order, across the blocks, in the lower of the homes where both are.
        first = np.where(visits[j, home_at[i]], home[i], MAX_CELLS)
        second = np.where(visits[i, home_at[j]], home[j], MAX_CELLS)
        once = (i < j) & (np.minimum(first, second) == cell) & ((one == two) | (block[i] != block[j]))
        i, j = i[once], j[once]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        _tie(root, i, j)
    used = np.flatnonzero(links)
    return pa.table([pa.array(ids[used]), pa.array(links[used]), pa.array(ids[root[used]])], ["id", "links", "root"])


def _tie(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lower the roots over the pairs until both ends of each have one; a root is the least of its set."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        high, low = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]
