"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "entityloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Nothing here is needed for right results. On a cluster, set
    ``spark.checkpoint.dir`` to a folder every executor can reach.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # plans of hundreds of columns: do not record the Python line of each
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with its machine, so there
    the missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="entityloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame computed once and stored in the shared checkpoint folder.

    Its rows keep their partition and their order, also when an executor is
    lost, because readers go back to the stored files and not to the plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_path(spark: SparkSession) -> str:
    """A new folder name in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"


def largest_task(df: DataFrame) -> int:
    """The rows of the largest partition."""
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return parts.agg(F.max("n")).first()[0] or 0


def stored(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """The frame written as Parquet into the shared checkpoint folder and read back.

    For tables that are read more than once or by column; the order of their
    rows is not kept. Files are dealt to tasks by their bytes, so well
    compressed rows come in large numbers; with ``rows_per_task`` no file has
    more rows than that, and each one is a task of its own if a task got more.
    """
    spark = df.sparkSession
    path = stage_path(spark)
    if rows_per_task is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.option("maxRecordsPerFile", rows_per_task).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    if largest_task(found) <= rows_per_task:
        return found
    # files as dear to open as a task is large are neither packed together nor split; other reads keep their settings
    alone = spark.newSession()
    alone.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    alone.conf.set("spark.sql.files.openCostInBytes", "1g")
    return alone.read.schema(df.schema).parquet(path)
