"""Comma-delimited reference files (article and shop dimensions).

Semantics of a delimited text table: no header, no quote character (a comma always splits),
missing trailing fields and unparsable numbers become NULL, extra fields are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from orderlens.sources.schemas import ARTICLE_SCHEMA, SHOP_SCHEMA

SCHEMAS = {"dim_article": ARTICLE_SCHEMA, "dim_shop": SHOP_SCHEMA}
DELIMITED_OPTIONS = {
    "sep": ",",
    "header": "false",
    "quote": "",  # no quoting: an embedded comma splits the field
    "mode": "PERMISSIVE",
    "nullValue": "",
}


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**DELIMITED_OPTIONS).csv(path)


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows in the same text layout the readers above expect."""
    df.write.mode(mode).options(sep=",", header="false", quote="", nullValue="", emptyValue="").csv(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, ARTICLE_SCHEMA)


def read_shops(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, SHOP_SCHEMA)


def register_external(spark: SparkSession, table: str, path: str, schema: StructType) -> DataFrame:
    """CREATE EXTERNAL TABLE ... LOCATION path, then REFRESH: the table reads whatever files are there."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="csv", schema=schema, **DELIMITED_OPTIONS)
    spark.catalog.refreshTable(table)
    return spark.table(table)


@contextmanager
def external_tables(spark: SparkSession, folders: Mapping[str, str], database: str | None = None) -> Iterator[Callable[[str], DataFrame]]:
    """External tables over delimited folders for the time of a run: registered before it, dropped after it (the files stay).

    ``folders`` maps a view of ``SCHEMAS`` to its folder.  What is given back REFRESHes the table of a view and reads it, so
    files added since the table was created count.  Tables have names of the run, so that runs don't meet."""
    run = uuid.uuid4().hex[:12]
    names = {view: f"{f'{database}.' if database else ''}orderlens_{view}_{run}" for view in folders}
    created: list[str] = []

    def refreshed(view: str) -> DataFrame:
        spark.catalog.refreshTable(names[view])
        return spark.table(names[view])

    try:
        for view, folder in folders.items():
            created.append(names[view])
            register_external(spark, names[view], folder, SCHEMAS[view])
        yield refreshed
    finally:
        for name in created:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
