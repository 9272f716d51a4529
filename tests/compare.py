"""Comparing a DataFrame with the result of SQL on the same files."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{directory}/{table}.parquet')")
    return connection


def _plain(value):
    return repr(value) if not isinstance(value, float) else repr(round(value, 9))


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    return rows_by_name([d[0] for d in result.description], result.fetchall())
