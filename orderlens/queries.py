"""One query per operator of the report, each a callable ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole generated tables through ``sources.adapter`` (or stages derived
from them); ``orderlens.oracles`` holds the matching DuckDB SQL under the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import rules as R
from orderlens.functions.timefn import (
    LOCAL_TZ,
    contract_months,
    days_between,
    local_date,
    local_time,
    on_or_after,
    sales_date,
    sales_hour,
)
from orderlens.operators import flagged_values, not_in
from orderlens.plans import sinks, stages
from orderlens.plans.pipeline import period_bits
from orderlens.scratch import scratch, settled, workspace
from orderlens.sources import delimited
from orderlens.sources.adapter import FIXTURE_START, from_testdata
from orderlens.sources.inputs import Inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _inp(spark: SparkSession, sf_dir: str) -> Inputs:
    return from_testdata(spark, sf_dir)


def _base(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    return stages.base(inp, FIXTURE_START, bits=period_bits(inp, FIXTURE_START))


def _base_once(spark, sf_dir):
    """The base as a checkpoint, for what reads it several times: its joins run once, not for each reader."""
    return settled(_base(spark, sf_dir))


def _de(spark, sf_dir):
    return stages.delete_enriched(_base_once(spark, sf_dir))


def _chain(spark, sf_dir) -> dict[str, DataFrame]:
    """The stage chain with base and delete_enriched as checkpoints, which Spark deletes with the result."""
    inp = _inp(spark, sf_dir)
    return stages.run_chain(inp, FIXTURE_START, bits=period_bits(inp, FIXTURE_START), store=lambda _name, df: settled(df))


# ---- sources, sinks, table maintenance ----------------------------------------------------

@query
def scan_order_lines(spark, sf_dir):
    return _inp(spark, sf_dir).order_item


@query
def source_csv_articles(spark, sf_dir):
    with workspace(spark):
        path = scratch(spark, "dim_article_csv")
        delimited.write_delimited(_inp(spark, sf_dir).dim_article, path)
        return settled(delimited.read_articles(spark, path))


@query
def source_csv_shops(spark, sf_dir):
    with workspace(spark):
        path = scratch(spark, "dim_shop_csv")
        delimited.write_delimited(_inp(spark, sf_dir).dim_shop, path)
        return settled(delimited.read_shops(spark, path))


@query
def sink_stage_roundtrip(spark, sf_dir):
    """DROP + CREATE TABLE AS SELECT through the catalog: a table with other columns first, which the stage then replaces."""
    stage = stages.unique_products(_inp(spark, sf_dir), FIXTURE_START)
    table = f"orderlens_unique_products_{uuid.uuid4().hex[:12]}"
    try:
        sinks.publish(stage.select(F.col("productid").alias("stale_column")), table)
        return settled(sinks.publish(stage, table))
    finally:
        sinks.drop_table(spark, table)


@query
def refresh_external(spark, sf_dir):
    """External table over a folder; a file added after the first read shows up after REFRESH."""
    shops = _inp(spark, sf_dir).dim_shop
    with workspace(spark):
        path = scratch(spark, "dim_shop_ext")
        delimited.write_delimited(shops.where(F.col("shoptype") == "Flagship"), path)
        with delimited.external_tables(spark, {"dim_shop": path}) as refreshed:
            refreshed("dim_shop").count()
            delimited.write_delimited(shops.where(~(F.col("shoptype") == "Flagship")), path, mode="append")
            return settled(refreshed("dim_shop"))


# ---- projection ----------------------------------------------------------------------------

@query
def project_order_lines(spark, sf_dir):
    return _inp(spark, sf_dir).order_item.select(
        "row_id",
        F.col("row_id").alias("orderitemrowid"),
        F.col("prod_id").alias("productrowid"),
        F.col("net_pri").alias("netprice"),
        F.col("status_cd").alias("orderitemstatus"),
        F.col("action_cd").alias("actioncd"),
        F.col("par_order_item_id").alias("parentorderitemrowid"),
        "asset_integ_id",
    )


@query
def project_constants(spark, sf_dir):
    return _inp(spark, sf_dir).pos_sale.select(
        F.col("journal_id").alias("orderid"),
        F.lit(R.CASH).alias("level1"),
        F.lit(R.SERVICE_PLAN).alias("transactionsubtype_level2"),
        F.lit("").alias("shop_crm"),
        F.lit(0).alias("level3_order"),
    )


@query
def union_padded_branches(spark, sf_dir):
    return stages.paired_and_provide(_base_once(spark, sf_dir))


@query
def project_star_plus(spark, sf_dir):
    return _de(spark, sf_dir).select(
        "*", sales_date("transactiondate").alias("salesdate"), sales_hour("transactiondate").alias("saleshour")
    )


# ---- filters -------------------------------------------------------------------------------

@query
def filter_individual_complete(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    lines = inp.order_item.where(F.col("status_cd") == R.COMPLETE)
    return stages.individual_lines(inp, lines).select("row_id", "order_id", "subscriberid", "status_cd")


@query
def filter_in_list(spark, sf_dir):
    return _inp(spark, sf_dir).order_head.where(F.col("x_sub_type").isin(*R.ORDER_TYPES)).select(
        "row_id", "x_sub_type"
    )


@query
def filter_not_exclude(spark, sf_dir):
    return _inp(spark, sf_dir).dim_article.where(F.col("level3") != R.EXCLUDE).select("productid", "level3")


@query
def filter_local_date_from(spark, sf_dir):
    oh = _inp(spark, sf_dir).order_head
    return oh.where(stages.since_local("created", FIXTURE_START, LOCAL_TZ)).select(
        "row_id", "created", local_time("created").alias("transactiondate")
    )


@query
def filter_date_from(spark, sf_dir):
    ps = _inp(spark, sf_dir).pos_sale
    return ps.where(on_or_after(F.to_date("transaction_date"), FIXTURE_START)).select(
        "journal_id", "transaction_date"
    )


@query
def classify_days_window(spark, sf_dir):
    de = _de(spark, sf_dir).withColumn("daysdiff", days_between("old_serviceenddate", "transactiondate"))
    return de.select(
        "orderid", "product", "old_product_name", "daysdiff",
        F.when(R.in_renewal_window("daysdiff"), R.RENEWAL)
        .when(R.outside_renewal_window("daysdiff"), R.UPGRADE)
        .alias("window_class"),
    )


@query
def filter_like_ci(spark, sf_dir):
    p = _inp(spark, sf_dir).product_crm
    return p.where(R.contains_ci("name", R.TEMP_WORD) | R.contains_ci("name", R.PREPAID_WORD)).select("row_id", "name")


@query
def filter_not_like_ci(spark, sf_dir):
    p = _inp(spark, sf_dir).product_crm
    return p.where(~R.contains_ci("name", R.PREPAID_WORD)).select("row_id", "name")


@query
def filter_null_tests(spark, sf_dir):
    om = _inp(spark, sf_dir).order_item_om
    return om.where(F.col("service_end_dt").isNull() & F.col("last_upd").isNotNull()).select(
        "row_id", "last_upd", "service_end_dt"
    )


# ---- joins ---------------------------------------------------------------------------------

def _star(inp: Inputs, how: str) -> DataFrame:
    """Order line -> subscriber -> billing -> order -> product -> user -> order extension."""
    oi = inp.order_item
    san = inp.dim_subscriber.select("subscriberid", F.col("billingaccountid").alias("_san_ba"))
    ban = inp.dim_billing.select(F.col("billingaccountid").alias("_ban_ba"), "customertype", "linecategory")
    ord_ = inp.order_head.select(
        F.col("row_id").alias("_o_id"), F.col("order_num").alias("orderid"), "x_sub_type",
        F.col("status_cd").alias("orderstatus"), "created_by",
    )
    prod = inp.product_crm.select(F.col("row_id").alias("_p_id"), F.col("name").alias("product"))
    usr = inp.dim_user.select(F.col("userid").alias("_u_id"), "login")
    ord2 = inp.order_ext_2.select(F.col("row_id").alias("_o2_id"), F.col("x_shop_id").alias("shopname"))
    return (
        oi.join(san, F.col("serv_accnt_id") == F.col("subscriberid"), how)
        .join(ban, F.col("_san_ba") == F.col("_ban_ba"), how)
        .join(ord_, F.col("order_id") == F.col("_o_id"), how)
        .join(prod, F.col("prod_id") == F.col("_p_id"), "left")
        .join(usr, F.col("created_by") == F.col("_u_id"), "left")
        .join(ord2, F.col("_o_id") == F.col("_o2_id"), "left")
    )


STAR_COLUMNS = ["row_id", "subscriberid", "linecategory", "orderid", "product", "login", "shopname"]


@query
def join_left_star(spark, sf_dir):
    return _star(_inp(spark, sf_dir), "left").select(*STAR_COLUMNS)


@query
def join_left_then_filter(spark, sf_dir):
    """Outer joins whose right side is tested in WHERE are inner joins: written as such."""
    star = _star(_inp(spark, sf_dir), "inner")
    return star.where(
        (F.col("customertype") == R.INDIVIDUAL)
        & F.col("x_sub_type").isin(*R.ORDER_TYPES)
        & (F.col("orderstatus") == R.COMPLETE)
    ).select(*STAR_COLUMNS)


@query
def join_inner_articles(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    art = inp.dim_article.select(F.col("productid").alias("_a_id"), "level3", "facevalue")
    return inp.order_item.join(art, F.col("prod_id") == F.col("_a_id"), "inner").select(
        "row_id", "prod_id", "level3", "facevalue"
    )


@query
def join_latest_service(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    om = stages.latest_service_dates(inp).select(
        F.col("row_id").alias("_om_id"),
        F.col("service_start_dt").alias("servicestartdate"),
        F.col("service_end_dt").alias("serviceenddate"),
    )
    return inp.order_item.join(om, F.col("row_id") == F.col("_om_id"), "left").select(
        "row_id", "servicestartdate", "serviceenddate"
    )


@query
def join_self_add_delete(spark, sf_dir):
    return stages.added_with_removed(_base_once(spark, sf_dir)).select(
        "orderid", "hw_flag", "product", "old_product_name", "netprice", "old_netprice"
    )


@query
def join_order_mix(spark, sf_dir):
    b = _base_once(spark, sf_dir)
    return stages.with_order_flags(b, b).select("orderid", "row_id", "level3", _kinds_text().alias("order_kinds"))


def _kinds_text():
    """The kinds of an order as text; NULL for an order that has none of them."""
    found = F.coalesce(*[F.col(f) for f in stages.MIX_FLAGS]).isNotNull()
    return F.when(found, flagged_values(stages.MIX_FLAGS))


@query
def join_order_level1(spark, sf_dir):
    c = _chain(spark, sf_dir)
    tags = stages.order_level1(c["level1"]).select(F.col("orderid").alias("_t_order"), "level1")
    return c["delete_enriched"].join(tags, F.col("orderid") == F.col("_t_order"), "left").select(
        "orderid", "product", "level1"
    )


@query
def join_pos_by_journal(spark, sf_dir):
    pos = stages.pos_by_journal(_inp(spark, sf_dir))
    return _de(spark, sf_dir).join(pos, F.col("orderid") == F.col("_pos_order"), "left").select(
        "orderid", "product", "agent_pos", "shop_pos", "agent_name_pos"
    )


@query
def join_pos_within_10h(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    return stages.pos_within_window(stages.delete_enriched(stages.base(inp, FIXTURE_START)), inp, start=FIXTURE_START).select(
        "orderid", "subscriberid", "transactiondate", "agent_pos_subid", "shop_pos_subid", "pos_timestamp"
    )


@query
def join_comma_dealer(spark, sf_dir):
    return stages.dealers(_inp(spark, sf_dir)).select(
        F.col("_dealer_order").alias("order_num"), F.col("dealer").alias("dealer_name")
    )


@query
def join_dealer(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    de = stages.delete_enriched(stages.base(inp, FIXTURE_START))
    return de.join(stages.dealers(inp), F.col("orderid") == F.col("_dealer_order"), "left").select(
        "orderid", "product", "dealer"
    )


@query
def join_subscriber_type(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    st = inp.dim_sub_type.select(F.col("subscriberid").alias("_st_sub"), "subscribertypename")
    return inp.pos_sale.join(st, F.col("subscriberid") == F.col("_st_sub"), "left").select(
        "journal_id", "subscriberid", "subscribertypename"
    )


def _exclusive(spark, sf_dir, kind: str) -> DataFrame:
    de = _chain(spark, sf_dir)["delete_enriched"]
    kept = not_in(
        de.where(F.col("level3") == kind), "orderid",
        de.where(F.col("level3").isin(*stages.EXCLUSIVE_FLAGS[kind])), "orderid",
    )
    return kept.select("orderid", "product", "level3")


@query
def anti_exclusive_service(spark, sf_dir):
    return _exclusive(spark, sf_dir, R.SERVICE)


@query
def anti_exclusive_other(spark, sf_dir):
    return _exclusive(spark, sf_dir, R.OTHER)


@query
def anti_cash_only(spark, sf_dir):
    return stages.cash_only_sales(_inp(spark, sf_dir), FIXTURE_START).select(
        "journal_id", "articleno", "articlegroup", "subscriberid"
    )


# ---- aggregation, distinct, window, set operations ----------------------------------------

@query
def agg_order_mix(spark, sf_dir):
    return stages.order_flags(_base(spark, sf_dir)).select("orderid", flagged_values(stages.MIX_FLAGS).alias("level3"))


@query
def distinct_products(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    prod = inp.dim_product.select(
        F.col("productid").alias("_p_id"), F.col("productname").alias("product"),
        F.col("service_type").alias("product_type"),
    )
    return (
        inp.order_item.join(prod, F.col("prod_id") == F.col("_p_id"), "left")
        .select(F.col("prod_id").alias("productid"), "product", "product_type")
        .distinct()
    )


@query
def distinct_report_rows(spark, sf_dir):
    c = _chain(spark, sf_dir)
    tags = stages.order_level1(c["level1"]).select(F.col("orderid").alias("_t_order"), "level1")
    fanned = c["delete_enriched"].join(tags, F.col("orderid") == F.col("_t_order"), "left")
    return fanned.select("orderid", "product", "actioncd", "level1").distinct()


@query
def distinct_order_level1(spark, sf_dir):
    return stages.order_level1(_chain(spark, sf_dir)["level1"])


@query
def window_latest_row(spark, sf_dir):
    return stages.latest_service_dates(_inp(spark, sf_dir))


@query
def union_level_branches(spark, sf_dir):
    return stages.level1_by_branches(_chain(spark, sf_dir)["delete_enriched"])


@query
def union_report_cash(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    return stages.report_with_cash(_chain(spark, sf_dir)["report"], inp, FIXTURE_START)


# ---- scalar functions ----------------------------------------------------------------------

@query
def fn_local_time(spark, sf_dir):
    return _inp(spark, sf_dir).order_head.select(
        "row_id", "created", local_time("created").alias("transactiondate"), local_date("created").alias("local_day")
    )


@query
def fn_sales_date_hour(spark, sf_dir):
    return _inp(spark, sf_dir).pos_sale.select(
        "journal_id", sales_date("transaction_date").alias("salesdate"),
        sales_hour("transaction_date").alias("saleshour"),
    )


@query
def fn_days_diff(spark, sf_dir):
    return _inp(spark, sf_dir).order_item_om.select(
        "row_id", days_between("service_end_dt", "service_start_dt").alias("days")
    )


@query
def fn_contract_months(spark, sf_dir):
    return _inp(spark, sf_dir).order_item_om.select(
        "row_id", contract_months("service_end_dt", "service_start_dt").alias("months")
    )


@query
def fn_cast_int(spark, sf_dir):
    return _inp(spark, sf_dir).pos_sale.select("journal_id", R.whole_amount("item_total_amount").alias("netprice"))


@query
def fn_face_value_delta(spark, sf_dir):
    return _de(spark, sf_dir).select("orderid", "product", R.face_value_delta().alias("face_value_delta"))


@query
def fn_shop_name(spark, sf_dir):
    return _chain(spark, sf_dir)["report_cash"].select("orderid", "level1", "shopnamecombined")


# ---- business rules ------------------------------------------------------------------------

@query
def classify_order_mix(spark, sf_dir):
    return stages.order_mix(_base(spark, sf_dir))


@query
def classify_new(spark, sf_dir):
    return _inp(spark, sf_dir).order_head.select(
        "row_id", F.col("x_sub_type").alias("ordertype"),
        R.transaction_type_level1("x_sub_type").alias("transactiontype_level1"),
    )


@query
def classify_hw_flag(spark, sf_dir):
    return _inp(spark, sf_dir).dim_article.select("productid", "level3", R.hw_flag("level3").alias("hw_flag"))


def _level1_of(spark, sf_dir, kinds: tuple[str, ...]) -> DataFrame:
    l1 = _chain(spark, sf_dir)["level1"]
    return l1.where(F.col("level3").isin(*kinds)).select(
        "orderid", "level3", "product", "old_product_name", "daysdiff", "level1"
    )


@query
def classify_level1_hw(spark, sf_dir):
    return _level1_of(spark, sf_dir, (R.DEVICE, R.ACCESSORIES))


@query
def classify_level1_service(spark, sf_dir):
    return _level1_of(spark, sf_dir, (R.SERVICE,))


@query
def classify_level1_other(spark, sf_dir):
    return _level1_of(spark, sf_dir, (R.OTHER,))


@query
def classify_level2(spark, sf_dir):
    return _chain(spark, sf_dir)["report"].select("orderid", "product", "level1", "level2")


@query
def classify_shop_crm(spark, sf_dir):
    return _inp(spark, sf_dir).order_ext_2.select(
        "row_id", "x_channel", F.col("x_shop_id").alias("shopname"),
        R.shop_crm("x_channel", "x_shop_id").alias("shop_crm"),
    )


# ---- stages --------------------------------------------------------------------------------

@query
def stage_unique_products(spark, sf_dir):
    return stages.unique_products(_inp(spark, sf_dir), FIXTURE_START)


@query
def stage_base(spark, sf_dir):
    return _base(spark, sf_dir)


@query
def stage_delete_enriched(spark, sf_dir):
    return _de(spark, sf_dir)


@query
def stage_level1(spark, sf_dir):
    return _chain(spark, sf_dir)["level1"]


@query
def stage_report(spark, sf_dir):
    return _chain(spark, sf_dir)["report"]


@query
def stage_report_cash(spark, sf_dir):
    return _chain(spark, sf_dir)["report_cash"]


# ---- data-quality check (test strategy, not a report operator) ----------------------------

@query
def dq_label_counts(spark, sf_dir):
    """How many rows carry the report's in-band review labels, per stage and label."""
    c = _chain(spark, sf_dir)
    review = [R.CHECK, R.PROVIDE_OLD_DEVICE, R.PROVIDE_OLD_ACC]
    parts = [
        c["level1"].where(F.col("level1").isin(*review)).select(F.lit("level1").alias("stage"),
                                                                 F.col("level1").alias("label")),
        c["delete_enriched"].where(F.col("level3_category_case") == R.MISC).select(
            F.lit("delete_enriched").alias("stage"), F.col("level3_category_case").alias("label")),
        c["report"].where(F.col("shop_crm") == R.OUTBOUND_NVL).select(
            F.lit("report").alias("stage"), F.col("shop_crm").alias("label")),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("stage", "label").agg(F.count(F.lit(1)).alias("n"))
