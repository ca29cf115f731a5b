"""Run a registered query and its SQL over the same files and compare the rows."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = [tuple(repr(_scalar(row[i])) for i in order) for row in rows]
    return [names[i] for i in order], sorted(text)


def _scalar(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def spark_rows(df):
    return _canonical(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _canonical([column[0] for column in cursor.description], cursor.fetchall())
