"""Hold-out splits that give the same answer every time."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.operators.quantile import order_statistics

# Fixed value: hold-out share in use.
HOLD_OUT = 0.10


def hash_bucket(keys: Sequence[str], buckets: int = 100, seed: int = 0) -> Column:
    """A bucket from 0 that depends on the keys and the seed only."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets)).cast("int")


def arithmetic_bucket(key: str, buckets: int = 100, multiplier: int = 7919) -> Column:
    """A bucket from 0 of an integer key that any engine can recompute."""
    big = F.lit(1_000_003)
    return F.pmod(F.pmod(F.col(key), big) * F.lit(multiplier) % big, F.lit(buckets)).cast("int")


def with_hold_out(df: DataFrame, bucket: Column, share: float, name: str = "is_validation", buckets: int = 100) -> DataFrame:
    """A flag for the rows of the hold-out: the first ``share`` of ``buckets``, which must be whole buckets.

    Rows without a bucket are not held out.
    """
    held = round(share * buckets)
    if abs(held - share * buckets) > 1e-9 or share > 0 and held == 0:
        raise ValueError(f"a share of {share} is not a whole number of {buckets} buckets; use more buckets")
    return df.withColumn(name, F.coalesce(bucket < F.lit(held), F.lit(False)))


def with_ordered_hold_out(df: DataFrame, key: str, train_share: float = 0.9, name: str = "is_validation") -> DataFrame:
    """The first share of rows by a unique key trains, the rest is flagged.

    The border key is found by rank, so the table is not sorted.
    """
    n = df.select(F.count(key)).first()[0]
    train_rows = math.ceil(round(train_share * n, 6))
    if train_rows == 0:
        return df.withColumn(name, F.lit(True))
    border = order_statistics(df, {key: [train_rows - 1]})[key][0]
    return df.withColumn(name, F.coalesce(F.col(key) > F.lit(border), F.lit(False)))
