"""Queries of joins that the report has, too, run the report's own."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orderlens import queries
from orderlens.operators.key_filter import bits_for
from orderlens.plans import stages
from orderlens.sources.adapter import FIXTURE_START, from_testdata
from test_operators import skewed  # noqa: F401


def test_pos_by_journal_runs_the_stage(spark, sf_dir, monkeypatch):
    calls, stage = [], stages.pos_by_journal
    monkeypatch.setattr(stages, "pos_by_journal", lambda inp: calls.append(1) or stage(inp))
    assert queries.REGISTRY["join_pos_by_journal"](spark, sf_dir).columns == ["orderid", "product", "agent_pos", "shop_pos", "agent_name_pos"]
    assert calls


@pytest.mark.parametrize("query, stage", [("join_self_add_delete", "added_with_removed"), ("join_order_mix", "with_order_flags"), ("agg_order_mix", "order_flags")])
def test_joins_and_flags_run_the_stage(spark, sf_dir, monkeypatch, query, stage):
    calls, run = [], getattr(stages, stage)
    monkeypatch.setattr(stages, stage, lambda *a: calls.append(1) or run(*a))
    queries.REGISTRY[query](spark, sf_dir)
    assert calls


@pytest.mark.parametrize("query", ["union_padded_branches", "project_star_plus", "join_self_add_delete", "join_order_mix", "stage_delete_enriched"])
def test_queries_that_read_the_base_several_times_build_it_once(spark, sf_dir, query):
    """The inputs are scanned for the base alone, not once for each of its readers."""
    plan = queries.REGISTRY[query](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "FileScan" not in plan


@pytest.mark.parametrize("query", ["union_padded_branches", "stage_base", "stage_level1"])
def test_no_bitmaps_where_the_period_has_most_of_the_orders(spark, sf_dir, monkeypatch, query):
    given, base = [], stages.base
    monkeypatch.setattr(stages, "base", lambda inp, start, tz=stages.LOCAL_TZ, bits=0: given.append(bits) or base(inp, start, tz, bits))
    queries.REGISTRY[query](spark, sf_dir)
    assert given == [None]


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_service_history_is_reduced_to_the_periods_lines(spark, sf_dir):
    """Versions of other lines are dropped where they are read, below the group limit and the shuffle."""
    inp = from_testdata(spark, sf_dir)
    late = "2024-02-20"
    lines = stages.period_lines(inp, late, bits=bits_for(10_000)).select("row_id")
    latest = stages.latest_service_dates(inp, lines, bits_for(10_000))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("BroadcastHashJoin")
    wanted = {r.row_id for r in lines.collect()}
    found = {r.row_id: r for r in latest.collect()}
    every = {r.row_id: r for r in stages.latest_service_dates(inp).collect()}
    assert {i: found[i] for i in wanted if i in every} == {i: every[i] for i in wanted if i in every}
    # the rest of the history is gone, but for a few
    assert len(found) <= len(wanted) + len(every) // 8 < len(every)


def test_lines_of_the_period_are_all_kept(spark, sf_dir):
    inp = from_testdata(spark, sf_dir)
    for bits in (None, 1 << 15, 1 << 20):
        assert _bag(stages.base(inp, FIXTURE_START, bits=bits)) == _bag(stages.base(inp, FIXTURE_START))


def test_hot_product_is_split_in_base(spark, sf_dir, skewed):  # noqa: F811
    """60 % of the lines on one product, broadcasts off, no setting forced."""
    inp = from_testdata(spark, sf_dir)
    hot = inp.dim_article.where("level3 = 'Device'").first().productid
    share = F.pmod(F.xxhash64("row_id"), F.lit(10)) < 6
    lines = inp.order_item.withColumn("prod_id", F.when(share, F.lit(hot)).otherwise(F.col("prod_id"))).repartition(8)
    df = stages.base(replace(inp, order_item=lines), FIXTURE_START)
    n = Counter(r.productrowid for r in df.select("productrowid").collect())
    assert n[hot] > sum(n.values()) / 2
    df.collect()
    joins = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin(skew=true)" in x]
    assert any("prod_id" in x for x in joins)


def test_lines_without_an_order_and_a_hot_order_in_the_report(spark, sf_dir, skewed):  # noqa: F811
    """A third of the lines without an order, a third on one; the joins on the order give what the plain ones give."""
    inp = from_testdata(spark, sf_dir)
    de = stages.delete_enriched(stages.base(inp, FIXTURE_START))
    hot = inp.pos_order.where("crm_order IS NOT NULL").first().crm_order
    part = F.pmod(F.xxhash64("orderid", "product", "old_product_name"), F.lit(3))
    changed = F.when(part == 0, F.lit(None)).when(part == 1, F.lit(hot)).otherwise(F.col("orderid"))
    de = de.withColumn("orderid", changed).checkpoint().repartition(8)
    l1 = stages.level1(de)
    joined = stages.join_on_own_exchange(de, stages.by_order(de, l1, inp), "orderid", "_by_order", "left").drop("_by_order")
    tags = stages.order_level1(l1).select(F.col("orderid").alias("_tag_order"), "level1")
    plain = (
        de.join(tags, F.col("orderid") == F.col("_tag_order"), "left")
        .join(stages.pos_by_journal(inp), F.col("orderid") == F.col("_pos_order"), "left")
        .join(stages.dealers(inp), F.col("orderid") == F.col("_dealer_order"), "left")
        .select(*joined.columns)
    )
    assert _bag(joined) == _bag(plain)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert any("SortMergeJoin(skew=true)" in x and "orderid" in x for x in plan.splitlines())
    assert joined.where("orderid IS NULL").count() >= de.count() // 4
