"""The cluster entry point over stored input tables and delimited reference files."""

import json
from collections import Counter

import pytest

from orderlens.__main__ import main
from orderlens.plans import stages
from orderlens.sources import delimited
from orderlens.sources.adapter import FIXTURE_START, from_testdata
from orderlens.sources.inputs import Inputs


def test_cli_runs_report_from_stored_inputs(spark, sf_dir, tmp_path):
    inp = from_testdata(spark, sf_dir)
    specs = {}
    for name in Inputs.names():
        path = str(tmp_path / "in" / name)
        if name in ("dim_article", "dim_shop"):
            delimited.write_delimited(getattr(inp, name), path)
            specs[name] = {"csv": path}
        else:
            getattr(inp, name).write.parquet(path)
            specs[name] = {"parquet": path}
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps(specs))
    out = tmp_path / "out"
    main(["--tables", str(tables), "--start", FIXTURE_START, "--out", str(out)])
    got = spark.read.parquet(str(out / "report_cash"))
    want = stages.run_chain(inp, FIXTURE_START)["report_cash"]
    assert got.columns == want.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())


def _specs(inp, tmp_path, reference):
    specs = {}
    for name in Inputs.names():
        path = str(tmp_path / "in" / name)
        if name in delimited.SCHEMAS:
            delimited.write_delimited(getattr(inp, name), path)
            specs[name] = {reference: path}
        else:
            getattr(inp, name).write.parquet(path)
            specs[name] = {"parquet": path}
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps(specs))
    return str(tables)


@pytest.mark.parametrize("located", [False, True])
def test_cli_fills_tables_of_the_catalog(spark, sf_dir, tmp_path, located):
    """With external reference tables, into a database that holds tables of an earlier state; no other table is left."""
    inp = from_testdata(spark, sf_dir)
    tables = _specs(inp, tmp_path, "external")
    database = f"cli_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}.db'")
    spark.range(3).write.saveAsTable(f"{database}.report_cash")
    args = ["--tables", tables, "--start", FIXTURE_START, "--into", database]
    main([*args, "--location", str(tmp_path / "data")] if located else args)
    want = stages.run_chain(inp, FIXTURE_START)
    assert sorted(t.name for t in spark.catalog.listTables(database)) == sorted(want)
    for name in ("unique_products", "report_cash"):
        got = spark.table(f"{database}.{name}")
        assert got.columns == want[name].columns
        assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want[name].collect())
    if located:
        assert len(list((tmp_path / "data").iterdir())) == len(want)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_run_that_fails_leaves_the_old_tables(spark, sf_dir, tmp_path, monkeypatch):
    from orderlens.plans.pipeline import STAGE_ORDER, run_report_tables

    inp = from_testdata(spark, sf_dir)
    database = f"fails_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}.db'")
    names = {s: f"{database}.{s}" for s in STAGE_ORDER}
    for name in names.values():
        spark.range(3).write.saveAsTable(name)
    monkeypatch.setattr(stages, "report_cash", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_report_tables(spark, inp, FIXTURE_START, names)
    assert sorted(t.name for t in spark.catalog.listTables(database)) == sorted(STAGE_ORDER)
    assert all(spark.table(name).count() == 3 for name in names.values())
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_run_into_a_used_folder_is_a_full_rebuild(spark, sf_dir, tmp_path):
    from orderlens.plans.pipeline import run_report

    inp = from_testdata(spark, sf_dir)
    used, fresh = str(tmp_path / "used"), str(tmp_path / "fresh")
    run_report(spark, inp, FIXTURE_START, used)
    later = "2024-01-20"
    rows = [
        Counter(tuple(r) for r in spark.read.parquet(run_report(spark, inp, later, out)["report_cash"]).collect())
        for out in (used, fresh)
    ]
    assert rows[0] == rows[1]
