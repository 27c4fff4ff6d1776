"""Compares a Spark result with the result of its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()

# Spark type name -> DuckDB type name
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def check(df, con, sql: str) -> int:
    """Asserts equal names, types and rows; returns the number of rows."""
    relation = con.sql(sql)
    spark_types = {name: SAME_TYPE[kind] for name, kind in df.dtypes}
    duck_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    assert spark_types == duck_types
    got = rows_of(df.collect(), df.columns)
    expected = rows_of(relation.fetchall(), relation.columns)
    assert len(got) == len(expected)
    assert got == expected
    return len(got)
