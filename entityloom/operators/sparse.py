"""Indicators without a column each: every category value has a slot, a row or an entity a sparse vector.

Nothing here grows with the number of values but the table of slots: it is
numbered by a range sort, stays a table, and is broadcast only if its measured
size allows. An entity's vector holds the values it has, so the width of the
result follows the data and not the dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.operators.encode import BROADCAST_BYTES
from entityloom.operators.ordering import number_rows
from entityloom.operators.rollup import with_key
from entityloom.operators.skew import attach_by_key
from entityloom.schema import quoted
from entityloom.session import stage_path, stored


@dataclass(frozen=True)
class Slots:
    """``column, value, slot`` of every value seen in fitting; slots are numbered from 0 by column and value."""

    table: DataFrame
    columns: tuple[str, ...]
    size: int
    bytes: int
    missing: str

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``column`` and ``value`` get their ``slot``; values not seen in fitting have none."""
        if self.bytes <= BROADCAST_BYTES:
            return rows.join(F.broadcast(self.table), ["column", "value"], "left")
        return attach_by_key(rows, self.table, ["column", "value"], "left")


def _cells(df: DataFrame, columns: Sequence[str], missing: str):
    value = lambda c: F.coalesce(F.col(quoted(c)).cast("string"), F.lit(missing))
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns])).alias("__cell")


def fit_slots(*frames: DataFrame, columns: Sequence[str], missing: str = "") -> Slots:
    """Slots of all values the frames have; missing text is a value of its own."""
    columns = tuple(columns)
    if not columns or not frames:
        raise ValueError("slots need a table and a column")
    cells = reduce(lambda a, b: a.unionByName(b), [f.select(_cells(f, columns, missing)).select("__cell.*") for f in frames])
    table = stored(number_rows(cells.distinct(), ["column", "value"], "slot").withColumn("slot", F.col("slot").cast("int")))
    n, size = table.agg(F.count(F.lit(1)), F.sum(F.octet_length("value") + F.octet_length("column") + 16)).first()
    if n >= 1 << 31:
        raise ValueError("a vector has fewer than 2^31 slots")
    return Slots(table, columns, n, size or 0, missing)


def sparse_shares(df: DataFrame, key: str, slots: Slots, size: str = "n_rows") -> DataFrame:
    """``key``, its rows, and ``indices, shares``: which share of its rows has each value, by ascending slot.

    The sparse form of the category share. Rows are counted by key and value
    before they meet the slots. Rows of values not seen in fitting count as
    rows and have no slot. Rows without a key are left out.
    """
    if key in ("column", "value", "slot", size) or key in slots.columns:
        raise ValueError("the key needs a name of its own")
    long = with_key(df, key).select(quoted(key), _cells(df, slots.columns, slots.missing)).select(quoted(key), "__cell.*")
    counted = slots.attach(long.groupBy(quoted(key), "column", "value").agg(F.count(F.lit(1)).alias("__n")))
    seen = F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "__n")))
    # every row has one value in each column
    rows = (F.sum("__n") / F.lit(len(slots.columns))).cast("bigint")
    grouped = counted.groupBy(quoted(key)).agg(rows.alias(size), F.sort_array(seen).alias("__seen"))
    share = lambda x: x["__n"] / F.col(quoted(size))
    return grouped.select(quoted(key), quoted(size), F.col("__seen.slot").alias("indices"), F.transform("__seen", share).alias("shares"))


def sparse_rows(df: DataFrame, slots: Slots) -> DataFrame:
    """The rows with ``indices, shares`` in place of the text columns: 1 for the value of each column that has a slot."""
    kept = [c for c in df.columns if c not in slots.columns]
    if {"indices", "shares"} & set(kept):
        raise ValueError("indices and shares are names of the result")
    rows = df
    for i, c in enumerate(slots.columns):
        codes = slots.table.filter(F.col("column") == c).select(F.col("value").alias("__value"), F.col("slot").alias(f"__slot{i}"))
        rows = rows.withColumn("__value", F.coalesce(F.col(quoted(c)).cast("string"), F.lit(slots.missing)))
        if slots.bytes <= BROADCAST_BYTES:
            rows = rows.join(F.broadcast(codes), "__value", "left").drop("__value")
        else:
            rows = attach_by_key(rows, codes, ["__value"], "left").drop("__value")
    found = F.array_sort(F.array_compact(F.array(*[F.col(f"__slot{i}") for i in range(len(slots.columns))])))
    rows = rows.select(*[F.col(quoted(c)) for c in kept], found.alias("indices"))
    return rows.withColumn("shares", F.transform("indices", lambda _: F.lit(1.0)))


def as_vectors(df: DataFrame, slots: Slots, name: str = "features") -> DataFrame:
    """``indices, shares`` as a sparse vector that MLlib's estimators read.

    The parts of a vector are written to the shared folder under the layout
    of the vector type and read back as one, so no Python touches a row.
    """
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(slots.size).alias("size"), F.col("indices"), F.col("shares").alias("values")
    )
    kept = [f for f in df.schema.fields if f.name not in ("indices", "shares")]
    if name in [f.name for f in kept]:
        raise ValueError(f"{name} exists")
    path = stage_path(df.sparkSession)
    df.select(*[F.col(quoted(f.name)) for f in kept], parts.alias(name)).write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([*kept, T.StructField(name, VectorUDT())])).parquet(path)
