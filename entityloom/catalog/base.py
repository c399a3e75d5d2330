"""Registration of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def stable(c: Column | str) -> Column:
    """A computed double cut to seven significant digits.

    Sums depend on the order of addition in the last bits, in any engine.
    """
    return (F.col(c) if isinstance(c, str) else c).cast("float").cast("double")


def stable_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.selectExpr(*[f"double(float(`{c}`)) AS `{c}`" if c in names else f"`{c}`" for c in df.columns])


def all_stable(df: DataFrame) -> DataFrame:
    return stable_columns(df, *[n for n, t in df.dtypes if t == "double"])


def st(expression: str) -> str:
    """``stable`` in SQL."""
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"
