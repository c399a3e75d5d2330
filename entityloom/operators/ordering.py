"""Global order without a single sorting task: positions, running sums, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.session import checkpointed

# monotonically_increasing_id() holds the partition above this bit, the row below
_ROW_BITS = 33


def _sorted_parts(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The rows range sorted and stored, with ``__part`` and ``__row`` telling their place.

    Stored, because the two readers below must see the same partitions.
    """
    place = F.monotonically_increasing_id()
    return checkpointed(df.orderBy(*by)).select(
        "*",
        F.shiftright(place, _ROW_BITS).alias("__part"),
        place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__row"),
    )


def _offsets(parts: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per partition, the totals of all partitions before it (one row per partition)."""
    per_part = parts.groupBy("__part").agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("__part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals])


def number_rows(df: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Position of each row in the order, from 0. ``by`` should leave no ties."""
    parts = _sorted_parts(df, by)
    offsets = _offsets(parts, {"__before": F.count(F.lit(1))})
    # as many rows as the sort has partitions
    joined = parts.join(F.broadcast(offsets), "__part")
    return joined.select(*df.columns, (F.col("__before") + F.col("__row")).alias(name))


def running_sums(df: DataFrame, by: Sequence[str | Column], columns: dict[str, str]) -> DataFrame:
    """For each ``{column: name}`` the sum over all earlier rows, without the row itself."""
    parts = _sorted_parts(df, by)
    offsets = _offsets(parts, {f"__before_{c}": F.sum(c) for c in columns})
    earlier = Window.partitionBy("__part").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    local = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__local_{c}") for c in columns]
    joined = parts.select("*", *local).join(F.broadcast(offsets), "__part")
    return joined.select(
        *df.columns, *[(F.col(f"__before_{c}") + F.col(f"__local_{c}")).alias(n) for c, n in columns.items()]
    )


def top(df: DataFrame, by: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The n rows with the largest value; ``tie`` decides among equals."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(n)


def in_top(df: DataFrame, by: str, n: int, tie: Sequence[str], column: str, value: str | Column) -> DataFrame:
    """One row ``in_top``: whether the value (or that of a scalar subquery) is among the n largest rows."""
    return top(df, by, n, tie).agg(
        F.coalesce(F.max(F.when(F.col(column) == value, F.lit(1))), F.lit(0)).alias("in_top")
    )


def first_rows(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The first n rows of the order (a stable prefix)."""
    return df.orderBy(*by).limit(n)


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows chosen by the md5 of their key as text; the same ones every time, in any engine."""
    return df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), F.col(key)).limit(n)
