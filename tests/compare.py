"""Order-insensitive comparison of Spark results with DuckDB results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(t) else str(t)


def _rows(table: pa.Table) -> list[tuple]:
    table = table.select(sorted(table.column_names))
    rows = [tuple(r[c] for c in table.column_names) for r in table.to_pylist()]
    clean = [tuple(None if isinstance(v, float) and math.isnan(v) else
                   (v + 0.0 if isinstance(v, float) else v) for v in row) for row in rows]
    return sorted(clean, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    """Empty when schema, row count and every value agree."""
    mine = {f.name: _kind(f.type) for f in spark_table.schema}
    theirs = {f.name: _kind(f.type) for f in duck_table.schema}
    found = [f"schema {c}: {mine.get(c)} / {theirs.get(c)}"
             for c in sorted(mine.keys() | theirs.keys()) if mine.get(c) != theirs.get(c)]
    if set(mine) != set(theirs):
        return found
    a, b = _rows(spark_table), _rows(duck_table)
    if len(a) != len(b):
        found.append(f"rows {len(a)} / {len(b)}")
    found += [f"{x} / {y}" for x, y in zip(a, b) if x != y][:3]
    return found
