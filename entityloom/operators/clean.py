"""Cleaning and imputation. Each operator is one projection.

Only the column means need a second look at the data; they enter the plan as
one scalar subquery, so nothing is collected and nothing is cross joined.
Expressions are SQL text: wide tables get hundreds of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.schema import (
    floating_columns,
    is_floating,
    is_numeric,
    is_text,
    numeric_columns,
    quoted,
    sql_literal,
    text_columns,
)

# Marks for "unknown" in the loan tables.
TEXT_SENTINELS = ("XNA/XAP", "XNA")
NUMBER_SENTINELS = (365243,)

FINITE = "abs({0}) < double('Infinity')"  # also false for NaN, which sorts above infinity


def project(df: DataFrame, changed: Mapping[str, str]) -> DataFrame:
    """All columns in their order, some of them replaced by SQL expressions."""
    return df.selectExpr(*[f"{changed.get(c, quoted(c))} AS {quoted(c)}" for c in df.columns])


def _cleaned(
    name: str, data_type, nonfinite: bool, texts: Sequence[str], numbers: Sequence[float], text_fill: str | None
) -> str:
    """One cell without its non-finite and sentinel values."""
    c = quoted(name)
    if is_text(data_type):
        out = c
        if texts:
            out = f"CASE WHEN {c} IN ({', '.join(map(sql_literal, texts))}) THEN '' ELSE {c} END"
        return out if text_fill is None else f"coalesce({out}, {sql_literal(text_fill)})"
    keep = []
    if nonfinite and is_floating(data_type):
        keep.append(FINITE.format(c))
    if numbers and is_numeric(data_type) and data_type.typeName() != "boolean":
        keep.append(f"{c} NOT IN ({', '.join(map(sql_literal, numbers))})")
    return f"CASE WHEN {' AND '.join(keep)} THEN {c} END" if keep else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column (the form all operators expect)."""
    return project(df, {c: f"nanvl({quoted(c)}, NULL)" for c in floating_columns(df)})


def nullify_nonfinite(df: DataFrame, protect: Sequence[str] = ()) -> DataFrame:
    """Infinity and NaN become NULL."""
    return clean(df, protect, texts=(), numbers=(), text_fill=None, impute=None)


def nullify_sentinels(
    df: DataFrame,
    texts: Sequence[str] = TEXT_SENTINELS,
    numbers: Sequence[float] = NUMBER_SENTINELS,
    protect: Sequence[str] = (),
) -> DataFrame:
    """Text sentinels become ``''`` and number sentinels NULL (whole cells only)."""
    return clean(df, protect, texts, numbers, nonfinite=False, text_fill=None, impute=None)


def fill_text(df: DataFrame, value: str = "", protect: Sequence[str] = ()) -> DataFrame:
    """Missing text becomes the given text."""
    return project(df, {c: f"coalesce({quoted(c)}, {sql_literal(value)})" for c in text_columns(df, protect)})


def fill_number(df: DataFrame, value: float = 0, protect: Sequence[str] = ()) -> DataFrame:
    """Missing numbers become the given number; the column keeps its type."""
    changed = {}
    for c in numeric_columns(df, protect):
        type_ = df.schema[c].dataType.simpleString()
        if type_ != "boolean":
            changed[c] = f"coalesce({quoted(c)}, CAST({sql_literal(value)} AS {type_}))"
    return project(df, changed)


def with_global(df: DataFrame, name: str, aggregates: Mapping[str, str]) -> DataFrame:
    """A struct column ``name`` with SQL aggregates over all rows.

    It is one scalar subquery in one projection of its own. Written into every
    expression that needs a value of it, it would be planned once for each.
    """
    fields = ", ".join(f"{sql_literal(field)}, {aggregate}" for field, aggregate in aggregates.items())
    return df.withColumn(name, df.agg(F.expr(f"named_struct({fields})").alias(name)).scalar())


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None, protect: Sequence[str] = ()) -> DataFrame:
    """Missing numbers become the mean of the whole column (as double)."""
    chosen = [c for c in (columns or numeric_columns(df)) if c not in protect]
    if not chosen:
        return df
    known = with_global(df, "__means", {c: f"avg({quoted(c)})" for c in chosen})
    filled = {c: f"coalesce(CAST({quoted(c)} AS DOUBLE), __means.{quoted(c)})" for c in chosen}
    return known.selectExpr(*[f"{filled.get(c, quoted(c))} AS {quoted(c)}" for c in df.columns])


def clean(
    df: DataFrame,
    protect: Sequence[str] = (),
    texts: Sequence[str] = TEXT_SENTINELS,
    numbers: Sequence[float] = NUMBER_SENTINELS,
    nonfinite: bool = True,
    text_fill: str | None = "",
    impute: str | float | None = "mean",
) -> DataFrame:
    """Non-finite and sentinel values out, then text and numbers filled.

    ``protect`` holds keys and label: they are neither masked nor filled.
    ``impute`` is ``'mean'``, a number, or None for no fill. The first three
    steps share one projection, so the means are those of the cleaned values.
    """
    changed = {
        f.name: _cleaned(f.name, f.dataType, nonfinite, texts, numbers, text_fill)
        for f in df.schema
        if f.name not in protect
    }
    cleaned = project(df, changed)
    if impute is None:
        return cleaned
    if impute == "mean":
        return fill_mean(cleaned, protect=protect)
    return fill_number(cleaned, impute, protect)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a missing value in the given columns."""
    return df.na.drop(subset=list(columns))
