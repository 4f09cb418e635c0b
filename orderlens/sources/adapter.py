"""Derive the report's input views from the generated star-schema parquet tables.

The test data has orders, line items, parts, customers, suppliers, nations and an event
stream; this module maps them onto the CRM / POS layout the report reads.  Every view is a
projection (plus one join of line items to their order) of a whole table.  The same mapping
is written in DuckDB SQL in ``orderlens.oracles`` so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.inputs import Inputs

# ---- fixed values of the fixture mapping -------------------------------------------------
EPOCH_START = "2024-01-01 00:00:00"  # first order creation instant (UTC wall clock)
SUB_TYPE_BY_PRIORITY = {"1-URGENT": "Provide", "3-MEDIUM": "Migration", "4-NOT SPECIFIED": "Disconnect"}
SUB_TYPE_OTHER = "Modify"
ACTION_BY_RETURNFLAG = {"A": "Add", "R": "Delete", "N": "Update"}
LEVEL3_BY_PART_TYPE = {"LARGE": "Device", "MEDIUM": "Accessories", "PROMO": "Other", "SMALL": "Exclude"}
LEVEL3_OTHER = "Service"
ARTICLE_GROUP_BY_EVENT = {
    "click": "ETOPUP",
    "error": "Recharge Cards",
    "purchase": "Accessories",
    "signup": "Handset",
    "view": "Plan",
}
UNLISTED_PART_SIZE = 7  # parts of this size are in the article file under a number that no line carries
UNTRACKED_EVENT = "error"  # order details of these POS sales carry no journal id
# -------------------------------------------------------------------------------------------


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _map(c: str, mapping: dict[str, str], other: Column | str | None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when if expr is None else expr.when)(F.col(c) == k, F.lit(v))
    if other is None:
        return expr
    return expr.otherwise(other if isinstance(other, Column) else F.lit(other))


def _created(orderkey: Column) -> Column:
    return F.lit(EPOCH_START).cast("timestamp_ntz") + F.make_dt_interval(
        days=(orderkey % 30).cast("int"), hours=(orderkey % 24).cast("int")
    )


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_testdata(spark: SparkSession, sf_dir: str) -> Inputs:
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")
    customer = _read(spark, sf_dir, "customer")
    supplier = _read(spark, sf_dir, "supplier")
    nation = _read(spark, sf_dir, "nation")
    events = _read(spark, sf_dir, "events")

    ok = F.col("o_orderkey")
    order_head = orders.select(
        _s(ok).alias("row_id"),
        _s(ok).alias("order_num"),
        _created(ok).alias("created"),
        _map("o_orderpriority", SUB_TYPE_BY_PRIORITY, SUB_TYPE_OTHER).alias("x_sub_type"),
        F.when(F.col("o_orderstatus") == "O", "Open").otherwise("Complete").alias("status_cd"),
        _s("o_custkey").alias("created_by"),
        F.when(F.col("o_orderstatus") == "F", "Complete").otherwise("Pending").alias("x_sub_status"),
    )
    order_ext_2 = orders.select(
        _s(ok).alias("row_id"),
        F.when(ok % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("CRM Shop "), _s(ok % 12)))
        .alias("x_shop_id"),
        F.concat(F.lit("MENA"), _s(ok % 11)).alias("x_mena_user"),
        F.when(ok % 10 == 0, "eCommerce").when(ok % 10 == 1, "mapp").otherwise("Retail").alias("x_channel"),
    )
    order_ext_x = orders.select(
        _s(ok).alias("row_id"),
        F.when(ok % 3 == 0, F.concat(F.lit("Dealer "), _s(ok % 7))).alias("attrib_45"),
    )

    # order lines carry the service account of their order
    lines = lineitem.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "inner"
    )
    line_row_id = F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"))
    order_item = lines.select(
        line_row_id.alias("row_id"),
        _s("l_orderkey").alias("order_id"),
        _s("l_partkey").alias("prod_id"),
        _s("o_custkey").alias("serv_accnt_id"),
        _map("l_returnflag", ACTION_BY_RETURNFLAG, None).alias("action_cd"),
        F.when(F.col("l_partkey") % 10 == 9, "Pending").otherwise("Complete").alias("status_cd"),
        F.col("l_extendedprice").alias("net_pri"),
        F.lit(None).cast("string").alias("par_order_item_id"),
        _s("l_suppkey").alias("asset_integ_id"),
    )
    # service dates start at the order's creation time, a function of the order key alone
    order_item_om = lineitem.withColumn("_created", _created(F.col("l_orderkey"))).select(
        line_row_id.alias("row_id"),
        F.when(F.col("l_partkey") % 17 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_partkey")))
        .alias("last_upd"),
        F.col("_created").alias("service_start_dt"),
        F.when(
            F.col("l_linenumber") <= 4,
            F.col("_created") + F.make_dt_interval(days=(F.col("l_quantity") * 7 - 100).cast("int")),
        ).alias("service_end_dt"),
    )

    product_name = F.replace(F.replace(F.col("p_name"), F.lit("hot"), F.lit("temp")), F.lit("red"), F.lit("prepaid"))
    product_crm = part.select(
        _s("p_partkey").alias("row_id"),
        product_name.alias("name"),
        F.col("p_type").alias("body_style_cd"),
        F.col("p_brand").alias("part_num"),
    )
    dim_product = part.select(
        _s("p_partkey").alias("productid"),
        product_name.alias("productname"),
        F.col("p_type").alias("service_type"),
    )
    dim_article = part.select(
        F.when(F.col("p_size") == UNLISTED_PART_SIZE, F.concat("p_brand", F.lit("-"), _s("p_partkey")))
        .otherwise(_s("p_partkey")).alias("productid"),
        F.col("p_name").alias("productname"),
        F.col("p_name").alias("commercialproductname"),
        _map("p_type", LEVEL3_BY_PART_TYPE, LEVEL3_OTHER).alias("level3"),
        F.when(F.col("p_brand") == "Brand#1", "ChildSim").otherwise(F.col("p_brand")).alias("level4"),
        F.col("p_name").alias("description"),
        F.when(F.col("p_size") % 9 == 0, F.lit(None).cast("float"))
        .otherwise(((F.col("p_size") % 5) * 10).cast("float"))
        .alias("facevalue"),
        F.col("p_size").cast("int").alias("level3_order"),
    )
    dim_shop = nation.select(
        F.col("n_name").alias("shopname"),
        F.concat(F.lit("Area "), _s("n_regionkey")).alias("area"),
        F.when(F.col("n_nationkey") % 2 == 0, "Flagship").otherwise("Kiosk").alias("shoptype"),
        (F.col("n_nationkey") * 0.5).cast("float").alias("longitude"),
        (F.col("n_regionkey") * 1.25).cast("float").alias("latitude"),
        F.concat(F.lit("Zone "), _s("n_regionkey")).alias("area1"),
        F.lit("Retail").alias("type"),
        (F.col("n_nationkey") % 6 + 1).cast("int").alias("counters"),
    )

    ck = F.col("c_custkey")
    dim_subscriber = customer.select(
        _s(ck).alias("subscriberid"),
        _s(ck).alias("billingaccountid"),
        F.col("c_name").alias("serviceaccountname"),
        F.col("c_mktsegment").alias("connectiontype"),
        F.concat(F.lit("973"), _s(ck)).alias("msisdn"),
        F.concat(F.lit("SA"), _s(ck)).alias("serviceaccountnumber"),
    )
    dim_billing = customer.select(
        _s(ck).alias("billingaccountid"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Business").otherwise("Individual").alias("customertype"),
        F.col("c_mktsegment").alias("linecategory"),
        F.concat(F.lit("BA"), _s(ck)).alias("billingaccountnumber"),
    )
    dim_sub_type = customer.select(_s(ck).alias("subscriberid"), F.col("c_mktsegment").alias("subscribertypename"))
    sk = F.col("s_suppkey")
    dim_user = supplier.select(
        _s(sk).alias("userid"),
        F.concat(F.lit("login"), _s(sk)).alias("login"),
        F.when(sk % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("User "), _s(sk))).alias("username"),
    )

    ek, uk = F.col("event_id"), F.col("user_id")
    article_no = F.get_json_object(F.col("props"), "$.k")
    pos_sale = events.select(
        _s(ek).alias("journal_id"),
        _s(uk).alias("subscriberid"),
        F.col("ts").alias("transaction_date"),
        F.to_date("ts").cast("timestamp_ntz").alias("cash_day"),
        _map("event_type", ARTICLE_GROUP_BY_EVENT, None).alias("articlegroup"),
        article_no.alias("articleno"),
        F.col("event_type").alias("articlename"),
        F.col("value").alias("item_total_amount"),
        F.col("value").alias("transaction_amount"),
        F.when(ek % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("POS "), _s(ek % 9))).alias("shop"),
        F.concat(F.lit("A"), _s(uk % 20)).alias("agentid"),
        F.concat(F.lit("Agent "), _s(uk % 20)).alias("agent_firstname"),
        F.concat(F.lit("973"), _s(uk)).alias("msisdn"),
    )
    pos_order = events.select(
        F.when(F.col("event_type") == UNTRACKED_EVENT, F.lit(None).cast("string")).otherwise(_s(ek)).alias("journal_id"),
        _s(ek).alias("crm_order"),
        article_no.alias("articleno"),
        F.col("ts").alias("order_completion_date"),
    )

    return Inputs(
        order_item=order_item,
        order_head=order_head,
        order_ext_2=order_ext_2,
        order_ext_x=order_ext_x,
        order_item_om=order_item_om,
        product_crm=product_crm,
        dim_subscriber=dim_subscriber,
        dim_billing=dim_billing,
        dim_product=dim_product,
        dim_user=dim_user,
        dim_article=dim_article,
        dim_shop=dim_shop,
        dim_sub_type=dim_sub_type,
        pos_sale=pos_sale,
        pos_order=pos_order,
    )

# first local day of the reporting period on the generated data (fixed value)
FIXTURE_START = "2024-01-08"
