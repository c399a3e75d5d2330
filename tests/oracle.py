"""Runs a query on Spark and its SQL on DuckDB, and compares all rows exactly."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duckdb_session(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, connection, sql: str) -> list[str]:
    """Differences, or an empty list."""
    relation = connection.sql(sql)
    mine = dict(df.dtypes)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    problems = []
    if set(mine) != set(theirs):
        return [f"columns differ: only Spark {set(mine) - set(theirs)}, only SQL {set(theirs) - set(mine)}"]
    for name, type_ in mine.items():
        if SAME_TYPE.get(type_) != theirs[name]:
            problems.append(f"{name}: {type_} against {theirs[name]}")
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b = _rows(relation.columns, relation.fetchall())
    if a != b:
        problems.append(f"{sum(a.values())} rows against {sum(b.values())}, columns {sorted(mine)}")
        problems.append(f"only Spark: {list((a - b).items())[:3]}")
        problems.append(f"only SQL: {list((b - a).items())[:3]}")
    return problems
