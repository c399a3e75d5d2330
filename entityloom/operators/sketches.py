"""Profiles as stored columns: made once per part of a table, merged without its rows.

A profile has one row per profiled column (and per value of ``by``): exact
counts, sums and extremes beside a distinct-count sketch and a quantile sketch.
All columns are measured in one pass whose shuffle carries one row per task;
``count(DISTINCT ...)`` of many columns multiplies the rows instead. Profiles of
new partitions, or of train and test, are merged with those kept before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.schema import is_floating, is_numeric, quoted

# log2 of the buckets of a distinct-count sketch: about 0.8 % standard error, exact for a few hundred values.
DISTINCT_BITS = 14
# A quantile's rank is off by about 0.7 % of the rows, whatever their number.
QUANTILE_K = 400


def _kind(data_type: T.DataType) -> str:
    if is_floating(data_type) or isinstance(data_type, T.DecimalType):
        return "double"
    return "bigint" if is_numeric(data_type) else "string"


def _measured(field: T.StructField) -> Column:
    """Everything a profile row holds about one column; NaN counts as missing."""
    kind = _kind(field.dataType)
    cell = F.col(quoted(field.name)).cast(kind)
    if kind == "double":
        # 0.0 and -0.0 are one value
        cell = F.when(~F.isnan(cell), cell + F.lit(0.0))
    number = cell.cast("double") if kind != "string" else F.lit(None).cast("double")
    text = cell if kind == "string" else F.lit(None).cast("string")
    return F.struct(
        F.lit(field.name).alias("column"),
        F.lit(kind).alias("kind"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(cell).alias("n_present"),
        F.sum(number).alias("total"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.min(text).alias("low_text"),
        F.max(text).alias("high_text"),
        F.hll_sketch_agg(F.when(cell.isNotNull(), F.xxhash64(cell)), F.lit(DISTINCT_BITS)).alias("distinct"),
        (F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)) if kind != "string" else F.lit(None).cast("binary")).alias("quantiles"),
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per column and value of ``by`` (a partition column, say); by default all columns but ``by``.

    An empty table gives one row per column with zeros, or none with ``by``.
    """
    by = list(by)
    names = [c for c in df.columns if c not in by] if columns is None else list(columns)
    taken = {"column", "kind", "n_rows", "n_present", "total", "low", "high", "low_text", "high_text", "distinct", "quantiles"}
    if taken & set(by) or not names:
        raise ValueError("a profile needs columns, and parts whose names are not its own")
    rows = df.groupBy(*[F.col(quoted(c)) for c in by]).agg(F.array(*[_measured(df.schema[c]) for c in names]).alias("__all"))
    return rows.select(*[F.col(quoted(c)) for c in by], F.explode("__all").alias("__one")).select(*[F.col(quoted(c)) for c in by], "__one.*")


def merge_profiles(*profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles put together: of parts into the whole, of old and new rows, of several tables.

    A column that has one type here and another there keeps a row for each kind.
    """
    rows = reduce(lambda a, b: a.unionByName(b), profiles)
    return rows.groupBy(*[F.col(quoted(c)) for c in by], "column", "kind").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_present", "total")],
        *[f(c).alias(c) for f, c in ((F.min, "low"), (F.max, "high"), (F.min, "low_text"), (F.max, "high_text"))],
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def read_profile(profiles: DataFrame, at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``n_rows``, ``n_present``, ``n_distinct`` (estimate), ``mean``, extremes and ``quantiles`` (an array, as ``at``).

    Means and quantiles of text, and all of a column without a value, are missing.
    """
    some = (F.col("n_present") > 0) & (F.col("kind") != "string")
    kept = [F.col(quoted(c)) for c in profiles.columns if c not in ("total", "distinct", "quantiles")]
    asked = F.array(*[F.lit(float(p)) for p in at])
    return profiles.select(
        *kept,
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(some, F.col("total") / F.col("n_present")).alias("mean"),
        F.when(some, F.kll_sketch_get_quantile_double("quantiles", asked)).alias("quantiles"),
    )
