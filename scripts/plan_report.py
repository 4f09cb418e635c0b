"""Summarise the physical plan of every report stage as it would start at scale.

Broadcast joins are switched off (at 100 TB none of the order, line, service-date or POS
tables fits) and AQE is off, so the plan shows the static exchanges; each stage is planned
over the previous stages read back from Parquet, as in ``plans.pipeline.run_report``.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from orderlens.plans import stages  # noqa: E402
from orderlens.plans.pipeline import run_report  # noqa: E402
from orderlens.scratch import remove  # noqa: E402
from orderlens.session import local_session, shared_dir  # noqa: E402
from orderlens.sources.adapter import FIXTURE_START, from_testdata  # noqa: E402

OPS = re.compile(r"(Exchange \w+\([^)]*\)|SortMergeJoin \[[^\]]*\], \[[^\]]*\], \w+|BroadcastHashJoin|"
                 r"WindowGroupLimit \[[^\]]*\]|Generate \w+|HashAggregate\(keys=\[[^\]]*\]|"
                 r"Subquery|FileScan parquet)")


def summarise(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for raw in plan.splitlines():
        line = re.sub(r"#\d+L?", "", raw)
        indent = len(line) - len(line.lstrip(" :+-|*()0123456789"))
        m = OPS.search(line)
        if not m:
            continue
        text = m.group(0)
        if text == "FileScan parquet":
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            rs = re.search(r"ReadSchema: struct<([^>]*)>", line)
            ncols = len(rs.group(1).split(",")) if rs else "?"
            text = f"FileScan parquet: {ncols} columns read, pushed filters [{pf.group(1) if pf else ''}]"
        elif text.startswith("Exchange"):
            text = re.sub(r", ENSURE_REQUIREMENTS.*", "", text)
        lines.append("  " * (indent // 3) + text[:160])
    return lines


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    inp = from_testdata(spark, sf_dir)
    out = f"{shared_dir(spark)}/plans-{uuid.uuid4().hex}"
    paths = run_report(spark, inp, FIXTURE_START, out)
    read = {k: spark.read.parquet(v) for k, v in paths.items()}
    plans = {
        "unique_products": stages.unique_products(inp, FIXTURE_START),
        "base": stages.base(inp, FIXTURE_START),
        "delete_enriched": stages.delete_enriched(read["base"]),
        "level1": stages.level1(read["delete_enriched"]),
        "report": stages.report(read["delete_enriched"], read["level1"], inp),
        "report_cash": stages.report_cash(read["report"], inp, FIXTURE_START),
    }
    print("# PLANS - physical plan shape of each stage at scale\n")
    print("Generated by `python scripts/plan_report.py`: broadcast joins off, AQE off (the static plan a")
    print("100 TB run starts from; at run time AQE still coalesces partitions, splits skewed join")
    print("partitions and broadcasts any side measured under the threshold).  Each stage reads the")
    print("previous stages from Parquet, as `run_report` does.  Scans of the generated tables include")
    print("the test adapter's projections; on a cluster they are the warehouse tables.\n")
    for name, df in plans.items():
        s = summarise(df)
        n_ex = sum(1 for x in s if x.lstrip().startswith("Exchange hashpartitioning"))
        print(f"## {name}: {n_ex} hash exchanges\n\n```")
        print("\n".join(s))
        print("```\n")
    remove(spark, out)


if __name__ == "__main__":
    main()
