"""Benchmark: the report stages at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each headline query is executed in full into Spark's no-op sink (nothing is collected to the
driver).  ``pipeline`` is the materialised run that writes all six stages as Parquet.
Times are the median of $BENCH_REPEAT warm runs (default 3) after one warm-up run;
``min_max`` gives the fastest and slowest run of each, since a shared host adds noise.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
HEADLINE = [
    "stage_unique_products",
    "stage_base",
    "stage_delete_enriched",
    "stage_level1",
    "stage_report",
    "stage_report_cash",
]


def _sf(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name[2:]) if name.startswith("sf") else name
    except ValueError:
        return name


def main() -> None:
    from orderlens.plans.pipeline import run_report
    from orderlens.queries import REGISTRY
    from orderlens.scratch import remove
    from orderlens.session import local_session, shared_dir
    from orderlens.sources.adapter import FIXTURE_START, from_testdata

    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    scratch = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"

    def run_query(name: str) -> float:
        t = time.perf_counter()
        REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    def run_pipeline(i: int) -> float:
        t = time.perf_counter()
        run_report(spark, from_testdata(spark, SF_DIR), FIXTURE_START, f"{scratch}/run{i}")
        return time.perf_counter() - t

    run_query("stage_report_cash")  # warm-up: JVM, code generation, file listing caches
    runs: dict[str, list[float]] = {}
    for name in HEADLINE:
        runs[name] = [run_query(name) for _ in range(REPEAT)]
    runs["pipeline"] = [run_pipeline(i) for i in range(REPEAT)]
    times = {k: statistics.median(v) for k, v in runs.items()}
    out = {
        "metric": "report_chain_sec",
        "value": round(times["pipeline"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "min_max": {k: [round(min(v), 3), round(max(v), 3)] for k, v in runs.items()},
        "sf": _sf(SF_DIR),
        "cpus": int(CPUS),
        "repeat": REPEAT,
    }
    remove(spark, scratch)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
