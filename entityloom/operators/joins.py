"""Joins, unions and membership, with explicit rules for names and missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.operators.columns import shared_columns
from entityloom.schema import quoted


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which a missing key matches a missing key."""
    on = list(on)
    tagged = right.select(*[F.col(quoted(c)).alias(f"__r_{c}" if c in on else c) for c in right.columns])
    condition = reduce(
        lambda a, b: a & b, [F.col(quoted(k)).eqNullSafe(F.col(quoted(f"__r_{k}"))) for k in on]
    )
    joined = left.join(tagged, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    keys = {k: F.coalesce(F.col(quoted(k)), F.col(quoted(f"__r_{k}"))).alias(k) for k in on}
    rest = [c for c in right.columns if c not in on]
    return joined.select(*[keys.get(c, F.col(quoted(c))) for c in left.columns], *[F.col(quoted(c)) for c in rest])


def join_with_suffixes(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffixes: tuple[str, str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Equi join; names both sides have (but for the keys) get the suffix of their side."""
    on = list(on)
    clash = {c for c in left.columns if c in right.columns and c not in on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(quoted(c)).alias(c + suffix if c in clash else c) for c in df.columns])

    a, b = renamed(left, suffixes[0]), renamed(right, suffixes[1])
    twice = (set(a.columns) & set(b.columns)) - set(on)
    for side in (a, b):
        twice |= {c for c in side.columns if side.columns.count(c) > 1}
    if twice:
        raise ValueError(f"suffixes {suffixes} leave equal names: {', '.join(sorted(twice))}")
    return join_null_safe(a, b, on, how) if null_safe else a.join(b, on, how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on all names both sides have."""
    on = shared_columns(left, right)
    if not on:
        raise ValueError("the tables share no column")
    return join_null_safe(left, right, on, how) if null_safe else left.join(right, on, how)


def fold_outer(blocks: Sequence[DataFrame], keys: Sequence[str] | None = None) -> DataFrame:
    """Full outer join of blocks that have one row per key.

    The blocks are stacked and regrouped by key, so there is one shuffle for
    all of them instead of one more with every block, and a missing key
    matches a missing key. Key columns default to the names all blocks share.
    """
    keys = list(keys) if keys is not None else shared_columns(*blocks)
    values = [[c for c in b.columns if c not in keys] for b in blocks]
    names = [c for part in values for c in part]
    if len(set(names)) != len(names):
        raise ValueError("blocks share value columns; rename them or make them keys")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    return stacked.groupBy(*keys).agg(*[F.first(quoted(c), ignorenulls=True).alias(c) for c in names])


def fold_outer_rows(blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """As ``fold_outer`` for blocks that repeat keys: a chain of real full joins."""
    return reduce(lambda a, b: join_null_safe(a, b, keys, "full"), blocks)


def in_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other table.

    The ids are never collected; they are made distinct first, so that an id
    with many rows is one row in the shuffle.
    """
    return df.join(ids.select(key).distinct(), key, "left_semi")


def union_all_columns(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column one of them lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(tag: str, **frames: DataFrame) -> DataFrame:
    """As ``union_all_columns`` with a column that tells the parts apart again."""
    return union_all_columns(*[f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


def untag(df: DataFrame, tag: str, name: str) -> DataFrame:
    """One part of a tagged union."""
    return df.filter(F.col(tag) == name).drop(tag)


def chain_block(df: DataFrame, key: str, size: str, sums: Sequence[str]) -> DataFrame:
    """One row per key: how many rows it has, and sums of columns."""
    totals = [F.sum(F.col(c).cast("double")).alias(c) for c in sums]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(size), *totals)


def chain_totals(blocks: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """Row count and sums of the inner many-to-many chain of tables on one key.

    Every table comes as its ``(block, size)`` with one row per key: a key with
    a, b and c rows stands for a * b * c joined rows, and a sum over one table
    is repeated once for each pairing of the others. No pair is ever built.
    """
    joined = reduce(lambda a, b: a.join(b, key, "inner"), [block for block, _ in blocks])
    # counts multiply past the range of a long on hot keys
    counts = {size: F.col(size).cast("double") for _, size in blocks}
    outputs = [F.col(key), reduce(lambda a, b: a * b, counts.values()).alias("chain_rows")]
    for block, size in blocks:
        factor = reduce(lambda a, b: a * b, [c for s, c in counts.items() if s != size], F.lit(1.0))
        outputs += [(F.col(c) * factor).alias(f"chain_sum_{c}") for c in block.columns if c not in (key, size)]
    return joined.select(*outputs)
