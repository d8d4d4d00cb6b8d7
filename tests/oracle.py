"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def row_key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=row_key)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), sorted_rows(columns, result.fetchall())
