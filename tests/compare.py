"""Spark result against DuckDB result: column names, column types, and rows as a multiset."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Spark type name to the DuckDB type that holds the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def _rows(names, order, rows) -> Counter:
    positions = [names.index(name) for name in order]
    return Counter(tuple(_plain(row[position]) for position in positions) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected_rows = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} for {sorted(names)}"]
    found = []
    for field in df.schema:
        wanted = TYPES.get(field.dataType.simpleString())
        if wanted != types[field.name]:
            found.append(f"{field.name}: {field.dataType.simpleString()} for {types[field.name]}")
    order = sorted(names)
    actual = _rows(df.columns, order, df.collect())
    expected = _rows(names, order, expected_rows)
    if actual != expected:
        found.append(
            f"{sum(actual.values())} rows for {sum(expected.values())}; "
            f"only Spark {list((actual - expected).items())[:2]}, "
            f"only SQL {list((expected - actual).items())[:2]}"
        )
    return found
