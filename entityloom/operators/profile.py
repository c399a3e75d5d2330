"""Profiles of columns: summary statistics and behaviour of the label by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.operators.clean import with_global
from entityloom.operators.quantile import GATHER_ROWS, exact_percentiles
from entityloom.schema import numeric_columns, quoted

QUARTILES = (0.25, 0.5, 0.75)


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None, gather_rows: int = GATHER_ROWS) -> DataFrame:
    """One row per numeric column: count, mean, std, min, exact quartiles, max."""
    chosen = list(columns) if columns is not None else numeric_columns(df)
    quartiles = exact_percentiles(df, chosen, QUARTILES, gather_rows)
    cells = []
    for c in chosen:
        value = F.col(quoted(c)).cast("double")
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                *[F.lit(q).cast("double").alias(f"p{round(p * 100)}") for p, q in zip(QUARTILES, quartiles[c])],
                F.max(value).alias("max"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("cell")).select("cell.*")


def target_profile(df: DataFrame, label: str, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Mean and count of the label for every value of every column, in one job.

    Values are compared as text; missing values make no group, and rows without
    a label do not count.
    """
    chosen = list(columns) if columns is not None else [c for c in df.columns if c != label and c not in exclude]
    long = df.select(label, *[F.col(quoted(c)).cast("string").alias(c) for c in chosen]).unpivot(
        label, chosen, "column", "value"
    )
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.avg(label).alias("target_mean"), F.count(label).alias("target_count"))
    )


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns brought to [0, 1]; a constant column becomes 0."""
    ends = {f"{f}_{c}": f"{f}(CAST({quoted(c)} AS DOUBLE))" for c in columns for f in ("min", "max")}

    def scaled(c: str) -> str:
        value, low, high = f"CAST({quoted(c)} AS DOUBLE)", f"__ends.{quoted('min_' + c)}", f"__ends.{quoted('max_' + c)}"
        return f"({value} - {low}) / CASE WHEN {high} = {low} THEN double(1) ELSE {high} - {low} END"

    return with_global(df, "__ends", ends).selectExpr(
        *[f"{scaled(c) if c in columns else quoted(c)} AS {quoted(c)}" for c in df.columns]
    )


def low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """Columns whose population variance does not exceed the threshold."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.var_pop(F.col(quoted(c)).cast("double")).alias("variance"))
        for c in columns
    ]
    return (
        df.agg(F.array(*cells).alias("cells"))
        .select(F.explode("cells").alias("cell"))
        .select("cell.*")
        .filter(F.col("variance") <= threshold)
    )
