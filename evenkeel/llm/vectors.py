"""What the operators on vectors share: usable rows, whole-number components, matrices of Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.sources.staging import BROADCAST_BYTES, ROW_OVERHEAD

SCHEMA = "vec_id bigint, embedding array<float>, label int"
# A component x stands for floor(SCALE * x), held within plus and minus LIMIT so that sums stay whole.
SCALE, LIMIT = 256, 1 << 26


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{sf_dir}/embeddings.parquet")


def finite(vector: str) -> Column:
    """True for a vector that is there and has neither a null nor a component that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A row of doubles per list; lists shorter than `width` are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component, held within the limit."""
    return np.floor(np.clip(x * SCALE, -LIMIT, LIMIT)).astype(np.int64)


def lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list per row of a matrix."""
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).reshape(-1), kind))


def with_totals(rows: DataFrame, totals: DataFrame, key: str, salts: int = 64) -> DataFrame:
    """`rows` with the columns of `totals`, a row per key (null is a key), where a key may hold any share of the rows.

    Totals of a size that was counted are broadcast; beyond it they are
    copied `salts` times and each key's rows are spread over the copies.
    """
    totals = totals.withColumnRenamed(key, "_key")
    if totals.count() * 2 * ROW_OVERHEAD <= BROADCAST_BYTES:
        return rows.join(F.broadcast(totals), rows[key].eqNullSafe(totals["_key"])).drop("_key")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    copies = totals.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = salted[key].eqNullSafe(copies["_key"]) & (salted["_salt"] == copies["_copy"])
    return salted.join(copies, same).drop("_key", "_salt", "_copy")
