"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings the operators rely on; all can be changed in a running session.
# A generated method above 8000 bytes is never compiled to machine code by the
# JVM, so wide projections run faster as split expressions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "procwarden", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name).config(
        "spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage.  Only where it is unset, as
    in local tests, a folder of our own is made; a cluster without the setting
    is refused, since a machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # Spark appends one uuid segment to the folder it was given.
            return current.rsplit("/", 1)[0]
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="procwarden-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(working_folder(spark), f"{name}-{uuid.uuid4().hex}")


class StepTables:
    """The step tables that are written while the object is entered; ``remove`` deletes them.

    Tables live until their reader is done, so a lost executor's work can be done again
    from them.  Entered objects nest; a table belongs to the innermost one of its thread.
    """

    _open = threading.local()

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> StepTables:
        self._open.stack = [*getattr(self._open, "stack", []), self]
        return self

    def __exit__(self, *_) -> None:
        self._open.stack = self._open.stack[:-1]

    def remove(self, spark: SparkSession, but: DataFrame | None = None) -> None:
        """Delete the tables, except those that ``but`` still reads."""
        read = list(but.inputFiles()) if but is not None and self.paths else []
        left = []
        for path in self.paths:
            if any(os.path.basename(path) in name for name in read):
                left.append(path)
            else:
                fs, where = file_system(spark, path)
                fs.delete(where, True)
        self.paths = left

    @classmethod
    def record(cls, path: str) -> None:
        stack = getattr(cls._open, "stack", None)
        if stack:
            stack[-1].paths.append(path)


@contextmanager
def step_tables(spark: SparkSession) -> Iterator[StepTables]:
    """A block after which the step tables written inside it are gone: write results within."""
    steps = StepTables()
    try:
        with steps:
            yield steps
    finally:
        steps.remove(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    The plan runs once (a checkpoint would run its last stage twice), the
    table survives lost executors, and later readers prune its columns.  Inside
    ``step_tables`` it goes at the end of the block.
    """
    path = scratch_path(df.sparkSession, "step")
    StepTables.record(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The written result of ``build``; the step tables written on the way go."""
    steps = StepTables()
    with steps:
        df = build()
    out = cut_lineage(df)
    steps.remove(spark)
    return out
