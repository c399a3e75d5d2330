"""Scans. Every scan turns NaN into NULL, the one form of missing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.operators.clean import nan_to_null
from entityloom.schema import schema_from_names

# Column types of the loan tables, by name; the first match decides.
LOAN_TYPES: list[tuple[str, T.DataType]] = [
    (r"^SK_ID_", T.LongType()),
    (r"^FLAG_OWN_(CAR|REALTY)$", T.StringType()),
    (r"^(TARGET$|FLAG_|REG_|REGION_RATING)", T.IntegerType()),
    (r"^(AMT_|CNT_|DAYS_|EXT_SOURCE_|DEF_|OBS_|SK_DPD|MONTHS_|REGION_POPULATION|OWN_CAR_AGE|HOUR_)", T.DoubleType()),
    (r"_(AVG|MEDI)$", T.DoubleType()),
    (r"^YEARS_.*_MODE$", T.DoubleType()),
]


def csv_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The names in the header; no data is read for types."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    rules: list[tuple[str, T.DataType]] | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header. Types come from the schema, from name rules, or from the data.

    Only the last reads the files an extra time.
    """
    if schema is None and rules is not None:
        schema = schema_from_names(csv_columns(spark, path, sep), rules, T.StringType())
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return nan_to_null(reader.csv(path))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables stored as ``{folder}/{name}.parquet``."""
    return scan_parquet(spark, f"{folder.rstrip('/')}/{name}.parquet")


def scan_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: scan_table(spark, folder, name) for name in names}


def scan_first(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most n rows, always the same ones: those with the smallest keys."""
    return df.orderBy(key).limit(n)


def scan_prefix(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of a Parquet scan in file order: files by path, rows as they lie in them.

    Files are counted in order, twice as many each time, until they hold n
    rows; a count reads footers and no column. All files but the last are
    taken whole and the last one up to its row position, so there is neither a
    sort nor a shuffle, and files behind the prefix are not read. ``df`` is a
    scan with its ``_metadata``; fewer than n rows are all rows, n = 0 is none.
    """
    if n < 0:
        raise ValueError("a prefix has 0 rows or more")
    # an address without a host is written with three slashes in the list and with one in the metadata
    files = sorted({re.sub(r"^([A-Za-z0-9+.\-]+):///", r"\1:/", f) for f in df.inputFiles()})
    path, whole, rest, step = F.col("_metadata.file_path"), [], n, 1
    while files and rest:
        some, files = files[:step], files[step:]
        counted = df.filter(path.isin(some)).groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        rows = {r["path"]: r["rows"] for r in counted.collect()}
        for at, name in enumerate(some):
            if rows.get(name, 0) >= rest:
                # the condition on the path alone keeps the other files out of the scan
                return df.filter(path.isin([*whole, name]) & ((path != name) | (F.col("_metadata.row_index") < rest)))
            rest -= rows.get(name, 0)
            whole.append(name)
        step *= 2
    return df.limit(0) if n == 0 else df
