"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=lambda row: [(v is None, str(v)) for v in row])


def _kind(field: pa.Field) -> str:
    kind = field.type
    if pa.types.is_large_string(kind):
        return "string"
    return "timestamp" if pa.types.is_timestamp(kind) else str(kind)


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """What differs in names, types or rows; empty if nothing does."""
    ours = {f.name: _kind(f) for f in spark_table.schema}
    theirs = {f.name: _kind(f) for f in sql_table.schema}
    if ours != theirs:
        return [f"schema {sorted(ours.items())} vs {sorted(theirs.items())}"]
    left, right = _rows(spark_table), _rows(sql_table)
    if len(left) != len(right):
        return [f"{len(left)} rows vs {len(right)}"]
    return [f"{a} vs {b}" for a, b in zip(left, right) if a != b][:3]
