"""Every registered query against its DuckDB oracle on the smallest generated tables."""

import re

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck
from orderlens.queries import REGISTRY

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


# plan nodes that must never appear: pair-producing joins without keys, Python evaluation
SLOW_PATH = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"
)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not SLOW_PATH.search(plan), SLOW_PATH.findall(plan)
    r = compare(df, con, entry.oracle_sql()[name])
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 44
    assert df.count() >= 0
