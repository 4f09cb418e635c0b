"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import scratch as _scratch
from orderlens.scratch import remove, settled  # noqa: F401

#: a word: a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


#: rows of an Arrow batch, where the session has Spark's default (10,000): texts are long, and a task holds a batch several times
BATCH_ROWS = 2000
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def importable(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it, besides their own path, and bound their batches."""
    if spark.conf.get(_BATCH) == _DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder of the open ``workspace``, or else in the shared folder itself."""
    return _scratch.scratch(spark, what, "llm")


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """As ``orderlens.scratch.workspace``; the Python workers can import this package."""
    importable(spark)
    with _scratch.workspace(spark, "llm"):
        yield


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage on storage that all executors see."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: bytes up to which a counted table is broadcast
SMALL_BYTES = 16 << 20


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, a stored table, broadcast in joins if its counted rows fit ``SMALL_BYTES``; else Spark joins it by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= SMALL_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` doesn't have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def word_count(text: str | Column) -> Column:
    """Number of words (``WORD``) of a text; 0 for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def hash_fraction(*parts: Column) -> Column:
    """A reproducible number in [0, 1) from the text of ``parts``: 52 bits of an MD5 (null: empty)."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
