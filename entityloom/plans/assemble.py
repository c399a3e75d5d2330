"""The wide table: one row per entity, with a block of columns from every child table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from entityloom.operators.clean import clean
from entityloom.operators.columns import drop_containing
from entityloom.operators.joins import union_tagged, untag
from entityloom.operators.rollup import group_means
from entityloom.schema import text_columns
from entityloom.session import stored


def attach_blocks(base: DataFrame, blocks: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Left joins of one-row-per-key blocks; a name that is taken gets ``_{block}``.

    The blocks come out of a grouping by the same key, so the joins find them
    partitioned the way they need.
    """
    result = base
    for name, block in blocks.items():
        taken = {c: f"{c}_{name}" for c in block.columns if c in result.columns and c != key}
        block = block.withColumnsRenamed(taken)
        twice = set(block.columns) & set(result.columns) - {key}
        if twice:
            raise ValueError(f"block {name} repeats columns: {', '.join(sorted(twice))}")
        result = result.join(block, key, "left")
    return result


def assemble(
    base: DataFrame,
    blocks: Mapping[str, DataFrame],
    key: str,
    protect: Sequence[str] = (),
    impute: str | float | None = "mean",
    one_row: bool = False,
    drop_parts: Sequence[str] = (),
    stage: bool = False,
) -> DataFrame:
    """Blocks attached, the result cleaned again, id columns dropped.

    ``one_row`` averages entities that ``base`` lists twice; protected text
    (the part) tells rows apart, other text falls away. ``stage`` stores the joined table before it is cleaned: the column
    means need a second look at it, and child tables are best read once.
    """
    wide = drop_containing(attach_blocks(base, blocks, key), drop_parts)
    if stage:
        wide = stored(wide)
    cleaned = clean(wide, protect=[key, *protect], impute=impute)
    return averaged(cleaned, key, protect) if one_row else cleaned


def averaged(df: DataFrame, key: str, protect: Sequence[str] = ()) -> DataFrame:
    """One row per entity, and per value of protected text columns: the means of all numbers, a protected label included."""
    texts = set(text_columns(df, []))
    return group_means(df, [key, *[c for c in protect if c in texts]])


def stack_parts(train: DataFrame, test: DataFrame, tag: str = "part") -> DataFrame:
    """Train and test rows in one table; the label is missing in the test rows."""
    return union_tagged(tag, train=train, test=test)


def split_parts(df: DataFrame, tag: str = "part") -> tuple[DataFrame, DataFrame]:
    """Train and test rows apart again, without a join."""
    return untag(df, tag, "train"), untag(df, tag, "test")
