"""Stage sinks: folders, and tables of the catalog with their life cycle (DROP, CREATE TABLE AS SELECT).

A table is published: its rows are written under a staging name first, and take the table's name once they are complete.
Until then the old table, whatever its columns, can be read; a failed write leaves it as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from orderlens.scratch import exists, remove


def write_stage(df: DataFrame, path: str) -> None:
    """Replace the stage at ``path`` (overwrite = DROP + CREATE; on failure re-run the stage)."""
    df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def quoted(table: str) -> str:
    """``db.table`` with each part in back quotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in ("Type", "Location")}


def _renamed(table: str, suffix: str) -> str:
    return f"{table}__{suffix}"


def stage_table(df: DataFrame, table: str, location: str | None = None) -> str:
    """Write ``df`` as a new table under a staging name; the name.

    ``location``: a folder under which each published state gets a folder of its own (on object stores, where a managed
    table's rename would copy its files); without it the table is managed, in the warehouse."""
    staging = _renamed(table, f"new_{uuid.uuid4().hex[:12]}")
    writer = df.write.format("parquet").mode("errorifexists")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{staging.split('.')[-1]}")
    writer.saveAsTable(quoted(staging))
    return staging


def swap_in(spark: SparkSession, staging: str, table: str) -> None:
    """Give a staged table its name.  The old one is set aside first, put back if that fails, and dropped with its files at the end."""
    aside = None
    if spark.catalog.tableExists(quoted(table)):
        aside = _renamed(table, f"old_{uuid.uuid4().hex[:12]}")
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(aside)}")
    try:
        _clear_leftover(spark, staging, table)
        spark.sql(f"ALTER TABLE {quoted(staging)} RENAME TO {quoted(table)}")
    except Exception:
        if aside:
            spark.sql(f"ALTER TABLE {quoted(aside)} RENAME TO {quoted(table)}")
        raise
    if aside:
        drop_table(spark, aside)


def _clear_leftover(spark: SparkSession, staging: str, table: str) -> None:
    """Remove a folder that no table has, where the managed table is about to be: files of an earlier one, with other columns perhaps."""
    described = _described(spark, staging)
    if described["Type"] == "MANAGED":
        folder = described["Location"].rpartition("/")[0] + "/" + table.split(".")[-1].lower()
        if exists(spark, folder):
            remove(spark, folder)


def publish(df: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """DROP TABLE IF EXISTS and CREATE TABLE AS SELECT as one step that readers see whole; the new table."""
    spark = df.sparkSession
    staging = stage_table(df, table, location)
    try:
        swap_in(spark, staging, table)
    except Exception:
        drop_table(spark, staging)
        raise
    return spark.table(quoted(table))


def publish_all(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Swap in several staged tables (staging name by table), one after the other, once all are written."""
    for table, staging in staged.items():
        swap_in(spark, staging, table)


def drop_table(spark: SparkSession, table: str) -> None:
    """DROP TABLE IF EXISTS, with the files, also those of a table at a location of its own."""
    if not spark.catalog.tableExists(quoted(table)):
        return
    described = _described(spark, table)
    spark.sql(f"DROP TABLE {quoted(table)}")
    if described.get("Location") and exists(spark, described["Location"]):
        remove(spark, described["Location"])
