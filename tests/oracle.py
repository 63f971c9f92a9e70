"""Comparison of query results with the oracle SQL."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def types(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).removeprefix("large_") for f in table.schema}


def compare(frame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count and the differences found (none when both agree)."""
    ours = frame.toArrow()
    theirs = db.sql(sql).to_arrow_table()
    problems = []
    if types(ours) != types(theirs):
        problems.append(f"schema: {types(ours)} != {types(theirs)}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows: {ours.num_rows} != {theirs.num_rows}")
    if sorted(ours.column_names) == sorted(theirs.column_names):
        # As bags: doubles to twelve digits, the rest exactly.
        columns = ", ".join(f'printf(\'%.12g\', "{n}") AS "{n}"' if kind == "double" else f'"{n}"'
                            for n, kind in sorted(types(ours).items()))
        db.register("ours", ours)
        db.register("theirs", theirs)
        for one, other in (("ours", "theirs"), ("theirs", "ours")):
            extra = db.sql(f"SELECT {columns} FROM {one} EXCEPT ALL SELECT {columns} FROM {other}")
            found = extra.fetchall()
            if found:
                problems.append(f"values: {len(found)} rows only in {one}, e.g. {found[0]!r:.600}")
    return ours.num_rows, problems
