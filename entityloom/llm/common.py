"""What several operators share: reading, Arrow batches, stored stages."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.session import ensure_checkpoint_dir, stored

__all__ = ["drop_stored", "give_back", "kept_with_text", "map_batches", "map_slices", "per_worker", "shared_folder", "ship_package", "stored", "table", "text_bytes", "text_or_empty"]

# Bytes of text a Python worker holds as objects at once; longer texts come one by one.
SLICE_BYTES = 4 * 1024 * 1024
# Bytes of an Arrow batch on its way to a worker, where the session has no own setting.
BATCH_BYTES = 8 * 1024 * 1024
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package.

    A cluster has it installed or gets it with ``--py-files``, and workers of a
    session started in its folder, or with it on ``PYTHONPATH``, find it. Only
    where the driver found it by another way (a changed ``sys.path``), its
    files go to the workers through the context.
    """
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    known = [os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    context = spark.sparkContext
    if root in known or not os.path.isdir(package) or getattr(context, "_package_shipped", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "package"), "zip", root, os.path.basename(package))
    context.addPyFile(archive)
    context._package_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name inside the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def drop_stored(*frames: DataFrame) -> None:
    """Delete the folders of tables that ``stored`` made and that nothing reads any more.

    Only folders inside the checkpoint folder go; a plan that still reads one of them would fail.
    """
    spark = frames[0].sparkSession
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    root = java(spark.sparkContext.getCheckpointDir())
    root = root.getFileSystem(settings).makeQualified(root)
    for frame in frames:
        for folder in {os.path.dirname(f) for f in frame.inputFiles()}:
            path = java(folder)
            files = path.getFileSystem(settings)
            path = files.makeQualified(path)
            if path.getName().startswith("stage-") and path.getParent().equals(root):
                files.delete(path, True)


def map_slices(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``function`` on the Arrow batches of a task, none of which holds more than about ``slice_bytes``."""

    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        # texts of a batch are held by the JVM and by each worker at once; read when the plan runs
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            step = max(1, batch.num_rows * slice_bytes // max(batch.nbytes, slice_bytes))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)

    return df.mapInArrow(lambda batches: function(slices(batches)), schema)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` on every slice that ``map_slices`` makes, alone."""
    return map_slices(df, lambda batches: map(function, batches), schema)


_MADE: dict[str, object] = {}


def per_worker(key: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once for a key in each Python worker (the last four keys are kept)."""
    if key not in _MADE:
        while len(_MADE) >= 4:
            _MADE.pop(next(iter(_MADE)))
        _MADE[key] = make()
    return _MADE[key]


def give_back() -> None:
    """Freed memory goes back to the system; else a worker keeps what its largest task took, beside the tasks of others and the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a missing one is empty."""
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [b"" if x is None else x for x in binary.to_pylist()]


def text_or_empty(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def kept_with_text(docs: DataFrame, keep: tuple[str, ...] | list[str], text_col: str) -> DataFrame:
    """``kept``, a struct of the columns to keep, and ``text``, missing ones empty."""
    return docs.select(F.struct(*keep).alias("kept"), text_or_empty(text_col).alias("text"))
