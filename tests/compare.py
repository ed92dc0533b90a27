"""Compare a Spark result with a DuckDB result, value by value."""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duckdb_over(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(v):
    if v is None or isinstance(v, (bool, str)):
        return repr(v)
    if isinstance(v, Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{Decimal(repr(v)).normalize():f}"
    return str(v)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if equal, else a short description of the first difference."""
    ours = _canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    theirs = _canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{dict(zip(ours[0], a))} != {dict(zip(ours[0], b))}"
    return None
