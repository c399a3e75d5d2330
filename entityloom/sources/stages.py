"""Stage tables that a later run picks up again.

A stage is addressed by a fingerprint of what it is computed from: the analysed
plan and the files it reads, with their lengths and times. A stage counts as
done when its marker exists, which is written after its data; data without a
marker (a lost driver, a killed run) is written anew. The next stage reads the
stored one, whose path holds its fingerprint, so a change anywhere changes all
stages behind it and none before it.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.session import ensure_checkpoint_dir

_NAME = re.compile(r"[A-Za-z0-9_\-]+")
# tables whose rows the text of a plan does not tell
_UNSEEN = re.compile(r"\b(LocalRelation|LogicalRDD|ExternalRDD)\b")


@contextmanager
def _whole_plans(spark: SparkSession):
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan_text(df: DataFrame) -> str:
    """The analysed plan; columns are numbered in the order in which they appear, as their ids differ in every session."""
    with _whole_plans(df.sparkSession):
        text = df._jdf.queryExecution().analyzed().toString()
    seen: dict[str, str] = {}
    return re.sub(r"#(\d+)", lambda m: "#" + seen.setdefault(m.group(1), str(len(seen))), text)


def files_fingerprint(df: DataFrame) -> str:
    """A digest of path, length and time of every file the frame reads; no file is opened and no list collected."""
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return "none"
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    both = [F.xxhash64(F.lit(seed), "path", "length", "modificationTime") for seed in (1, 2)]
    row = listed.agg(F.count(F.lit(1)), F.sum("length"), *[F.bit_xor(h) for h in both]).first()
    return ":".join(map(str, row))


class Stages:
    """Stages below ``folder``, by default below the shared checkpoint folder. Nothing else may be kept there."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        if folder is None:
            ensure_checkpoint_dir(spark)
            folder = f"{spark.sparkContext.getCheckpointDir().rsplit('/', 1)[0]}/stages"
        self.spark, self.folder = spark, folder.rstrip("/")
        self.made: list[str] = []  # stages that this run computed
        self.found: list[str] = []  # stages that it picked up
        self._held: dict[str, str] = {}

    def _path(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def fingerprint(self, df: DataFrame, version: str = "") -> str:
        """What the stage is stored under.

        Python functions and reader options are not told by a plan, and neither
        are rows that came from the driver or a checkpoint: name them in
        ``version``. Without one, a plan with such rows is an error.
        """
        text = plan_text(df)
        if not version and (unseen := _UNSEEN.search(text)):
            raise ValueError(f"the plan holds a {unseen.group(1)}, whose rows it does not tell: give a version")
        parts = [version, text, df.schema.json(), files_fingerprint(df)]
        return hashlib.sha256("\0".join(parts).encode()).hexdigest()[:32]

    def stage(self, name: str, df: DataFrame, version: str = "") -> DataFrame:
        """The frame, read from its stage; computed and written only if that stage is not there."""
        if not _NAME.fullmatch(name):
            raise ValueError("a stage name has letters, digits, _ and - only")
        if name in self._held:
            raise ValueError(f"stage {name} exists in this run")
        mark = self.fingerprint(df, version)
        data = f"{self.folder}/{name}/{mark}"
        fs, done = self._path(f"{data}.done")
        if fs.exists(done):
            self.found.append(name)
        else:
            df.write.mode("overwrite").parquet(data)
            fs.create(done, True).close()
            self.made.append(name)
        self._held[name] = mark
        return self.spark.read.schema(df.schema).parquet(data)

    def finish(self, *keep: str) -> None:
        """Free the stages of this run but those named, and what earlier runs left under the names of this run.

        A marker goes before its data, so that a run which ends here leaves no stage that only looks done.
        """
        unknown = set(keep) - set(self._held)
        if unknown:
            raise ValueError(f"no stages of this run: {', '.join(sorted(unknown))}")
        for name, mark in self._held.items():
            fs, at = self._path(f"{self.folder}/{name}")
            kept = {mark, f"{mark}.done"} if name in keep else set()
            entries = [e.getPath() for e in fs.listStatus(at)]
            for path in sorted(entries, key=lambda p: not p.getName().endswith(".done")):
                if path.getName() not in kept:
                    fs.delete(path, True)
            if not kept:
                fs.delete(at, True)
        self._held = {n: m for n, m in self._held.items() if n in keep}
