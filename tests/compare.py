"""Compare a Spark result with its SQL oracle, value by value, ignoring row order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    return f"{type(value).__name__}:{value!r}"


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, row counts and all values (with their Python types) agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: {sorted(spark_df.columns)} but expected {sorted(names)}"]
    got = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    expected = _bag(names, expected_rows)
    if got == expected:
        return []
    extra, missing = list((got - expected).items())[:2], list((expected - got).items())[:2]
    return [f"rows {sum(got.values())} / {sum(expected.values())}", f"only Spark: {extra}", f"only SQL: {missing}"]
