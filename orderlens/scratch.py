"""Folders that a run writes to and clears again, in the shared folder of the session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from orderlens.session import shared_dir

_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def scratch(spark: SparkSession, what: str, under: str = "orderlens") -> str:
    """A new path in the folder of the open ``workspace``, or else under the shared folder itself."""
    return f"{_FOLDER.get() or f'{shared_dir(spark)}/{under}'}/{what}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


@contextmanager
def workspace(spark: SparkSession, under: str = "orderlens") -> Iterator[None]:
    """A folder of the run: what is written to ``scratch`` paths meanwhile goes at the end, also after a failure.

    What is returned must not read it any more: see ``settled``.  A workspace inside another one is a
    folder of its own, which goes earlier.
    """
    path = scratch(spark, "run", under)
    token = _FOLDER.set(path)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        remove(spark, path)


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint: it no longer reads the tables that a workspace holds.

    Spark deletes its files once nothing refers to the result any more, where the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    shared_dir(df.sparkSession)  # names the checkpoint folder where the session has none
    return df.checkpoint()
