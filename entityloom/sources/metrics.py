"""Metric logs of training runs: one tab-separated row per iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("iter", T.IntegerType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("logloss", T.DoubleType()),
    ]
)


def scan_metric_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", "\t").schema(LOG_SCHEMA).csv(path)


TIME_SCHEMA = T.StructType(
    [
        T.StructField("iter", T.IntegerType()),
        T.StructField("passed", T.DoubleType()),
        T.StructField("remaining", T.DoubleType()),
    ]
)


def scan_time_log(spark: SparkSession, path: str) -> DataFrame:
    """Seconds passed and expected to remain, per iteration."""
    return spark.read.option("header", True).option("sep", "\t").option("enforceSchema", True).schema(TIME_SCHEMA).csv(path)


def best_iteration(log: DataFrame) -> DataFrame:
    """The row with the highest AUC; the earliest among equals."""
    return log.orderBy(F.col("auc").desc(), "iter").limit(1)
