"""Choosing, renaming and adding columns; all decided at plan time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.schema import is_numeric, quoted


def keep(df: DataFrame, names: Sequence[str], strict: bool = True) -> DataFrame:
    """The named columns, in the given order; unless strict, absent ones are skipped."""
    if strict:
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*[F.col(quoted(n)) for n in names if n in df.columns])


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named columns; absent names are ignored."""
    gone = set(names)
    return df.select(*[F.col(quoted(c)) for c in df.columns if c not in gone])


def drop_containing(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Without the columns whose name contains one of the parts."""
    return drop_present(df, [c for c in df.columns if any(p in c for p in parts)])


def only_numeric(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(quoted(f.name)) for f in df.schema if is_numeric(f.dataType) or f.name in also])


def shared_columns(*frames: DataFrame) -> list[str]:
    """Names all frames have, in the order of the first."""
    return [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]


def add_constant(df: DataFrame, name: str, value: int | float | str = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def add_suffix(df: DataFrame, suffix: str, keep_names: Sequence[str]) -> DataFrame:
    """Every column renamed with the suffix, but for those to keep."""
    if isinstance(keep_names, str):
        raise TypeError("keep_names must be a list of names, not one text")
    return df.select(*[F.col(quoted(c)).alias(c if c in keep_names else c + suffix) for c in df.columns])


def append(df: DataFrame, **new: Column) -> DataFrame:
    """New columns beside the old ones, in one projection and without a join."""
    return df.select("*", *[c.alias(n) for n, c in new.items()])


def split_label(df: DataFrame, key: str, label: str) -> tuple[list[str], str]:
    """Names of the model inputs and of the label; the key is neither."""
    if label not in df.columns:
        raise ValueError(f"no label column {label}")
    return [c for c in df.columns if c not in (key, label)], label
