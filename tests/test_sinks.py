"""Tables of the catalog: publish, drop, and the external tables of a run."""

import pytest
from pyspark.sql import functions as F

from orderlens.plans import sinks
from orderlens.sources import delimited


@pytest.fixture
def database(spark, tmp_path):
    name = f"sinks_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def tables(spark, database):
    return sorted(t.name for t in spark.catalog.listTables(database))


@pytest.mark.parametrize("external", [False, True])
def test_publish_replaces_rows_and_columns(spark, database, tmp_path, external):
    location = str(tmp_path / "data") if external else None
    table = f"{database}.stage"
    sinks.publish(spark.range(5).select("id", F.lit("a").alias("old")), table, location)
    got = sinks.publish(spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(1.5).alias("new")), table, location)
    assert got.columns == ["id", "new"] and dict(got.dtypes) == {"id": "string", "new": "double"}
    assert sorted(r.id for r in spark.table(table).collect()) == ["0", "1", "2"]
    assert tables(spark, database) == ["stage"]
    # one folder with the files of this state alone
    folders = list((tmp_path / "data").iterdir()) if external else [p for p in (tmp_path / f"{database}.db").iterdir()]
    assert len(folders) == 1
    sinks.drop_table(spark, table)
    sinks.drop_table(spark, table)
    assert tables(spark, database) == [] and not folders[0].exists()


def test_files_of_no_table_are_cleared(spark, database, tmp_path):
    """A folder left where the table is about to be, of an earlier run with other columns, is no part of the new table."""
    spark.range(9).select(F.col("id").alias("stale")).write.parquet(str(tmp_path / f"{database}.db" / "stage"))
    got = sinks.publish(spark.range(2), f"{database}.stage")
    assert got.columns == ["id"] and got.count() == 2


def test_failed_write_leaves_the_old_table(spark, database):
    table = f"{database}.stage"
    sinks.publish(spark.range(5), table)
    with pytest.raises(Exception):
        sinks.publish(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), table)
    assert spark.table(table).count() == 5


def test_failed_swap_puts_the_old_table_back(spark, database, monkeypatch):
    table = f"{database}.stage"
    sinks.publish(spark.range(5), table)
    monkeypatch.setattr(sinks, "_clear_leftover", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.publish(spark.range(6), table)
    assert spark.table(table).count() == 5 and tables(spark, database) == ["stage"]


def test_external_table_of_a_run(spark, tmp_path):
    folder = str(tmp_path / "shops")
    rows = lambda *ids: spark.createDataFrame([(i, "n") for i in ids], "a string, b string")
    delimited.write_delimited(rows("1"), folder)
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(RuntimeError), delimited.external_tables(spark, {"dim_shop": folder}) as refreshed:
        assert refreshed("dim_shop").count() == 1
        delimited.write_delimited(rows("2", "3"), folder, mode="append")
        assert refreshed("dim_shop").count() == 3
        raise RuntimeError
    assert {t.name for t in spark.catalog.listTables()} == before
    assert delimited.read_shops(spark, folder).count() == 3
