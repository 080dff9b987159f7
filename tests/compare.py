"""Comparing a Spark result with the rows of a DuckDB query."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def spark_rows(df) -> list[str]:
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql: str) -> tuple[list[str], list[str]]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return columns, rows_of(columns, result.fetchall())
