"""The full report run: every stage written once, downstream stages read it back.

``base`` and ``delete_enriched`` are read several times each (self join, product-mix flags,
level1 branches, report).  Writing them to shared storage cuts the lineage there: later
stages re-read Parquet instead of recomputing the joins, and a lost executor only costs the
tasks of the stage in flight, never a recomputation of the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.timefn import LOCAL_TZ
from orderlens.operators.key_filter import bits_for
from orderlens.plans import sinks, stages
from orderlens.sources.inputs import Inputs

STAGE_ORDER = ["unique_products", "base", "delete_enriched", "level1", "report", "report_cash"]
#: lines for each order that the bitmaps of orders and lines have room for
LINES_PER_ORDER = 4
#: of all orders, the share of the period's up to which reading the lines twice for the bitmaps saves more shuffle than it costs
REDUCED_SHARE = 0.25


def period_bits(inp: Inputs, start: str, tz: str = LOCAL_TZ) -> int | None:
    """Bits of the bitmaps of the period's orders and lines, by two counts of narrow rows; None: they cost more than they save."""
    orders = stages.orders_in_scope(inp, start, tz).agg(F.count(F.lit(1))).first()[0]
    reduce = orders <= REDUCED_SHARE * inp.order_head.count()
    return bits_for(LINES_PER_ORDER * orders) if reduce else None


def _run(inp: Inputs, start: str, tz: str, put: Callable[[str, DataFrame], DataFrame]) -> None:
    """Build every stage in order; ``put`` writes one and returns what later ones read."""
    bits = period_bits(inp, start, tz)
    put("unique_products", stages.unique_products(inp, start, tz, bits))
    b = put("base", stages.base(inp, start, tz, bits))
    de = put("delete_enriched", stages.delete_enriched(b))
    l1 = put("level1", stages.level1(de))
    rpt = put("report", stages.report(de, l1, inp, tz, start))
    put("report_cash", stages.report_cash(rpt, inp, start))


def run_report(spark: SparkSession, inp: Inputs, start: str, out_dir: str, tz: str = LOCAL_TZ) -> dict[str, str]:
    """Build and write all six stages under ``out_dir``; returns stage name -> path.

    Every run rebuilds every stage, so that a folder never mixes two periods or two states of
    the inputs."""
    out = out_dir.rstrip("/")
    paths = {name: f"{out}/{name}" for name in STAGE_ORDER}

    def put(name: str, df: DataFrame) -> DataFrame:
        sinks.write_stage(df, paths[name])
        return sinks.read_stage(spark, paths[name])

    _run(inp, start, tz, put)
    return paths


def run_report_tables(
    spark: SparkSession, inp: Inputs, start: str, tables: Mapping[str, str], tz: str = LOCAL_TZ, location: str | None = None
) -> dict[str, str]:
    """Build all six stages as tables of the catalog (stage name -> table); returns that mapping.

    Stages are written under staging names, which the later stages read.  Only when all six are complete do they take the
    tables' names: a run that fails leaves the old tables, of one state, readable, and none of its own behind."""
    missing = set(STAGE_ORDER) - set(tables)
    if missing:
        raise ValueError(f"no table for {', '.join(sorted(missing))}")
    staged: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        staged[tables[name]] = sinks.stage_table(df, tables[name], location)
        return spark.table(sinks.quoted(staged[tables[name]]))

    try:
        _run(inp, start, tz, put)
        sinks.publish_all(spark, staged)
    except Exception:
        for staging in staged.values():
            sinks.drop_table(spark, staging)
        raise
    return {name: tables[name] for name in STAGE_ORDER}
