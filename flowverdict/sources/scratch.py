"""Folders and tables for intermediate results that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders that this driver has named and not removed.
_FOLDERS: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local master; on a cluster the
    executors could not read each other's files there, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="flowverdict-")
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(folder)
    return folder


def remove_scratch(spark: SparkSession, folders: list[str] | None = None) -> int:
    """Delete scratch folders, by default all of this driver; how many there were.

    Results are lazy, so this is for when they have been written or collected.
    """
    removed = 0
    for folder in list(_FOLDERS if folders is None else folders):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if folder in _FOLDERS:
            _FOLDERS.remove(folder)
    return removed


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Folders that are named inside are deleted at the end, also after an error."""
    before = set(_FOLDERS)
    try:
        yield
    finally:
        remove_scratch(spark, [f for f in _FOLDERS if f not in before])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch table and read back: cuts the lineage, prunes columns.

    The table stays until ``remove_scratch`` or the end of a ``scratch_scope``, since the frame that
    reads it is lazy.
    """
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder the cluster names in ``spark.checkpoint.dir``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint()
