"""Row-by-row comparison of a registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple[str, ...]]]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), _rows(columns, result.fetchall())
