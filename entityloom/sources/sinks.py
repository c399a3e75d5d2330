"""Sinks and stage files. Nothing is written through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from entityloom.sources.tables import scan_parquet


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV files with headers and without an index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def staged(df: DataFrame, path: str) -> DataFrame:
    """The frame written to a shared folder and read back; its plan starts there."""
    write_parquet(df, path)
    return scan_parquet(df.sparkSession, path)
