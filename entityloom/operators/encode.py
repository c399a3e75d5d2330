"""Categorical encoding: values are fitted first, so that schemas are fixed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.operators.clean import fill_number, fill_text
from entityloom.operators.ordering import number_rows
from entityloom.operators.skew import attach_by_key
from entityloom.schema import quoted, safe_name, sql_literal, text_columns

# The code tables of one transform are broadcast up to this many bytes of text, and 16
# bytes per row, all together; the smallest come first.
BROADCAST_BYTES = 32 * 1024 * 1024


def _long_form(df: DataFrame, columns: Sequence[str], missing: str | None) -> DataFrame:
    """(column, value) rows of the given text columns."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(quoted(c)) if missing is None else F.coalesce(F.col(quoted(c)), F.lit(missing))).alias("value"),
        )
        for c in columns
    ]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def fit_values(
    df: DataFrame, columns: Sequence[str] | None = None, protect: Sequence[str] = (), max_values: int = 2000
) -> dict[str, list[str]]:
    """The sorted distinct values of each text column, without missing.

    They become column names, so there must be few: more than ``max_values``
    in a column is an error and never a silent cut.
    """
    chosen = list(columns) if columns is not None else text_columns(df, protect)
    if not chosen:
        return {}
    limit = max_values * len(chosen)
    found = _long_form(df, chosen, None).na.drop().distinct().limit(limit + 1).collect()
    values = {c: sorted(r["value"] for r in found if r["column"] == c) for c in chosen}
    wide = [c for c, v in values.items() if len(v) > max_values]
    if wide or len(found) > limit:
        raise ValueError(f"more than {max_values} values to turn into columns: {', '.join(wide) or chosen}")
    return values


def indicator_columns(
    values: dict[str, Sequence[str]], missing: str | None = None, missing_flag: bool = False
) -> dict[str, str]:
    """{name: SQL of a 0/1 column} for each value, named ``feature_{column}_{value}``.

    ``missing`` is the text a missing cell counts as; ``missing_flag`` adds a
    ``_nan`` column for missing cells.
    """
    out: dict[str, str] = {}

    def add(name: str, condition: str) -> None:
        n, free = 2, name
        while free in out:
            free, n = f"{name}_{n}", n + 1
        out[free] = f"CASE WHEN {condition} THEN 1 ELSE 0 END"

    for column, listed in values.items():
        cell = quoted(column)
        if missing is not None:
            cell = f"coalesce({cell}, {sql_literal(missing)})"
        for value in listed:
            add(f"feature_{column}_{safe_name(value)}", f"{cell} = {sql_literal(value)}")
        if missing_flag:
            add(f"feature_{column}_nan", f"{quoted(column)} IS NULL")
    return out


def one_hot(
    df: DataFrame, values: dict[str, Sequence[str]], protect: Sequence[str] = (), numeric_fill: float | None = 0
) -> DataFrame:
    """Text columns replaced by one indicator per value and one for missing."""
    filled = df if numeric_fill is None else fill_number(df, numeric_fill, protect)
    kept = [quoted(c) for c in filled.columns if c not in values]
    flags = indicator_columns(values, missing_flag=True)
    return filled.selectExpr(*kept, *[f"{sql} AS {quoted(n)}" for n, sql in flags.items()])


def drop_text(df: DataFrame, protect: Sequence[str] = (), numeric_fill: float | None = 0) -> DataFrame:
    """Text columns dropped, numbers filled."""
    gone = set(text_columns(df, protect))
    filled = df if numeric_fill is None else fill_number(df, numeric_fill, protect)
    return filled.selectExpr(*[quoted(c) for c in filled.columns if c not in gone])


def append_indicators(
    df: DataFrame, values: dict[str, Sequence[str]], missing: str = "", protect: Sequence[str] = ()
) -> DataFrame:
    """Indicators beside the text columns; missing text becomes a value of its own first."""
    listed = {c: sorted({*v, missing}) for c, v in values.items()}
    filled = fill_text(fill_number(df, 0, protect), missing, [c for c in df.columns if c not in values])
    flags = indicator_columns(listed)
    return filled.selectExpr("*", *[f"{sql} AS {quoted(n)}" for n, sql in flags.items()])


@dataclass(frozen=True)
class LabelCodes:
    """Fitted codes: a table (column, value, code) and its size in bytes per column."""

    table: DataFrame
    sizes: dict[str, int]
    missing: str

    def transform(self, df: DataFrame, numeric_fill: float | None = None, protect: Sequence[str] = ()) -> DataFrame:
        """Text columns replaced by their codes; a value not seen in fitting is missing."""
        result = df if numeric_fill is None else fill_number(df, numeric_fill, protect)
        names = result.columns
        sizes = {c: s for c, s in sorted(self.sizes.items(), key=lambda x: x[1]) if c in names}
        sent = 0
        for column, size in sizes.items():
            sent += size
            codes = self.table.filter(F.col("column") == column).select(
                F.col("value").alias("__value"), F.col("code").alias("__code")
            )
            keyed = result.withColumn("__value", F.coalesce(F.col(quoted(column)), F.lit(self.missing)))
            if sent <= BROADCAST_BYTES:
                joined = keyed.join(F.broadcast(codes), "__value", "left")
            else:
                joined = attach_by_key(keyed, codes, ["__value"], "left")
            result = joined.select(
                *[F.col("__code").alias(c) if c == column else F.col(quoted(c)) for c in names]
            )
        return result


def fit_codes(
    *frames: DataFrame, columns: Sequence[str] | None = None, protect: Sequence[str] = (), missing: str = ""
) -> LabelCodes:
    """Codes 0, 1, 2 ... of the sorted distinct values over all frames, per text column.

    The values are sorted and numbered as a distributed table, so a column may
    have any number of them.
    """
    chosen = list(columns) if columns is not None else text_columns(frames[0], protect)
    if not chosen:
        raise ValueError("no text column to code")
    cells = reduce(lambda a, b: a.unionAll(b), [_long_form(f, chosen, missing) for f in frames])
    numbered = number_rows(cells.distinct(), ["column", "value"], "__position")
    # one row per column: where its values start, and how large they are
    starts = numbered.groupBy("column").agg(
        F.min("__position").alias("start"), F.sum(F.octet_length("value") + F.lit(16)).alias("bytes")
    ).collect()
    start = reduce(
        lambda c, r: c.when(F.col("column") == r["column"], F.lit(r["start"])), starts, F.when(F.lit(False), F.lit(0))
    )
    table = numbered.select("column", "value", (F.col("__position") - start).cast("int").alias("code"))
    return LabelCodes(table, {r["column"]: r["bytes"] for r in starts}, missing)


def label_encode(
    df: DataFrame, protect: Sequence[str] = (), missing: str = "", numeric_fill: float | None = 0
) -> DataFrame:
    """Fit and transform on one frame."""
    return fit_codes(df, protect=protect, missing=missing).transform(df, numeric_fill, protect)


def codes_table(codes: LabelCodes) -> DataFrame:
    """The fitted codes, ready to be stored."""
    return codes.table
