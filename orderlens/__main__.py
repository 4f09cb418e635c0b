"""Run the full report on a cluster.

    spark-submit -m orderlens --tables tables.json --start 2019-08-31 --out <shared folder>
    spark-submit -m orderlens --tables tables.json --start 2019-08-31 --into <database> [--location <shared folder>]

``tables.json`` maps every input view name (see ``orderlens.sources.inputs.Inputs``) to a
catalog table name, or to ``{"parquet": path}`` / ``{"csv": path}`` / ``{"external": folder}`` (the last two for the
delimited reference files, which use their declared schemas; an external folder is a table of the catalog for the time of
the run, refreshed before it is read).  With --out, each stage is written as Parquet under the folder.  With --into, each is
a table of the database, named as the stage, which takes the place of the old one when the whole run is complete; --location
keeps its files in a folder of that path instead of the warehouse.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from orderlens.functions.timefn import LOCAL_TZ
from orderlens.plans.pipeline import STAGE_ORDER, run_report, run_report_tables
from orderlens.sources import delimited
from orderlens.sources.inputs import Inputs


def bind(spark: SparkSession, name: str, spec) -> DataFrame:
    if isinstance(spec, str):
        return spark.table(spec)
    if "parquet" in spec:
        return spark.read.parquet(spec["parquet"])
    if "csv" in spec and name in delimited.SCHEMAS:
        return delimited.read_delimited(spark, spec["csv"], delimited.SCHEMAS[name])
    raise ValueError(f"{name}: expected a table name or a parquet, csv or external path, got {spec!r}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="orderlens", description=__doc__.split("\n")[0])
    ap.add_argument("--tables", required=True, help="JSON file: input view name -> table or path")
    ap.add_argument("--start", required=True, help="first local day of the report, yyyy-mm-dd")
    target = ap.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="shared folder for the six stages")
    target.add_argument("--into", help="database for the six stage tables")
    ap.add_argument("--location", help="with --into: folder under which the tables keep their files")
    ap.add_argument("--tz", default=LOCAL_TZ, help="report time zone")
    args = ap.parse_args(argv)
    if args.location and not args.into:
        ap.error("--location needs --into")
    with open(args.tables) as fh:
        specs = json.load(fh)
    spark = SparkSession.builder.appName("orderlens-report").getOrCreate()
    folders = {name: spec["external"] for name, spec in specs.items() if name in delimited.SCHEMAS and isinstance(spec, dict) and "external" in spec}
    with delimited.external_tables(spark, folders, args.into) as refreshed:
        inputs = Inputs(**{name: refreshed(name) if name in folders else bind(spark, name, specs[name]) for name in Inputs.names()})
        if args.into:
            done = run_report_tables(spark, inputs, args.start, {s: f"{args.into}.{s}" for s in STAGE_ORDER}, args.tz, args.location)
        else:
            done = run_report(spark, inputs, args.start, args.out, args.tz)
    for stage, where in done.items():
        print(f"{stage}\t{where}")


if __name__ == "__main__":
    main()
