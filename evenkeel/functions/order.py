"""Seeded, reproducible row order and its digest buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_order(key: Column, seed: int = 0) -> Column:
    """A digest whose order is a seeded shuffle of the keys.

    It depends on the key and the seed only, so a task that is run again, or
    another partitioning, gives the same order.
    """
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def digest_bucket(order: Column, digits: int) -> Column:
    """Leading hex digits: 16**digits buckets that sort like the digest."""
    return F.substring(order, 1, digits)


def row_digest(columns: list[str]) -> Column:
    """Digest over whole rows; equal digests mean equal rows."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]),
                           {"ignoreNullFields": "false"}))
