"""Report stages as DataFrame -> DataFrame functions.

unique_products   order lines -> distinct products sold
base              order lines + customer, order, service dates, product, user, shop, article
delete_enriched   new (Add) lines paired with removed (Delete) lines of the same order and
                  hardware flag, plus all lines of new-connection orders; order product mix
level1            movement type (New / Upgrade / Renewal / ...) per line
report            order-level movement type, contract kind, CRM shop, POS matches, dealer
report_cash       report + cash-only POS sales, combined shop name, subscriber type
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import rules as R
from orderlens.functions.timefn import (
    LOCAL_TZ,
    contract_months,
    days_between,
    epoch_seconds,
    local_date,
    local_time,
    on_or_after,
    sales_date,
    sales_hour,
)
from orderlens.operators import (
    join_on_own_exchange,
    latest_per_key,
    left_join_within,
    pair_with_removed,
    presence_flags,
    reduced_to_keys,
    union_positional,
)
from orderlens.operators.key_filter import DEFAULT_BITS
from orderlens.sources.inputs import Inputs

# ---- fixed values ------------------------------------------------------------------------
POS_WINDOW_SECONDS = 600 * 60  # POS sale of the same subscriber less than 600 minutes away
# -------------------------------------------------------------------------------------------

ENRICHED_COLUMNS = [
    "level3_category_case", "transactiondate", "subscriberid", "customername", "linecategory", "msisdn",
    "orderid", "contractstartdate", "product", "old_product_name", "netprice", "old_netprice", "ordertype",
    "actioncd", "servicestartdate", "duration", "serviceenddate", "old_serviceenddate", "login", "username",
    "shopname", "x_channel", "level3", "old_level3", "level4", "old_level4", "facevalue", "old_facevalue",
    "level3_order", "description",
]
LEVEL1_COLUMNS = ["daysdiff", "level1"] + ENRICHED_COLUMNS
POS_COLUMNS = [
    "salesdate", "saleshour", "agent_pos", "shop_pos", "agent_name_pos", "agent_pos_subid", "shop_pos_subid",
    "dealer", "pos_timestamp",
]
REPORT_COLUMNS = ["level1", "level2", "shop_crm"] + ENRICHED_COLUMNS + POS_COLUMNS
REPORT_CASH_COLUMNS = REPORT_COLUMNS + ["shopnamecombined", "subscribertypename"]
OLD_COLUMNS = {  # paired Delete line column -> enriched column
    "product": "old_product_name",
    "netprice": "old_netprice",
    "serviceenddate": "old_serviceenddate",
    "level3": "old_level3",
    "level4": "old_level4",
    "facevalue": "old_facevalue",
}
MIX_FLAGS = {"has_service": R.SERVICE, "has_device": R.DEVICE, "has_acc": R.ACCESSORIES, "has_other": R.OTHER}


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def since_local(ts: str, start: str, tz: str) -> Column:
    """Local creation date on or after ``start``.  The extra bound on the raw column is implied
    by it (local offsets are under one day) and lets the scan skip files and row groups."""
    raw_bound = F.col(ts) >= (F.lit(start).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    return raw_bound & on_or_after(local_date(ts, tz), start)


def orders_in_scope(inp: Inputs, start: str, tz: str) -> DataFrame:
    return inp.order_head.where(
        F.col("x_sub_type").isin(*R.ORDER_TYPES)
        & (F.col("status_cd") == R.COMPLETE)
        & since_local("created", start, tz)
    )


def individual_lines(inp: Inputs, lines: DataFrame) -> DataFrame:
    """Order lines of individual (non-business) customers; the WHERE on the billing account
    makes the subscriber and billing outer joins inner joins.  The two dimensions are joined
    to each other first, so the line stream meets one (filtered) subscriber relation."""
    return lines.join(individual_subscribers(inp), lines["serv_accnt_id"] == F.col("subscriberid"), "inner")


def individual_subscribers(inp: Inputs) -> DataFrame:
    san = inp.dim_subscriber.select(
        F.col("subscriberid"),
        F.col("billingaccountid").alias("_san_ba"),
        F.col("serviceaccountname").alias("customername"),
        "connectiontype",
        "msisdn",
        "serviceaccountnumber",
    )
    ban = inp.dim_billing.where(F.col("customertype") == R.INDIVIDUAL).select(
        F.col("billingaccountid").alias("_ban_ba"), "linecategory", "billingaccountnumber"
    )
    return san.join(ban, F.col("_san_ba") == F.col("_ban_ba"), "inner").drop("_san_ba", "_ban_ba")


def unique_products(inp: Inputs, start: str, tz: str = LOCAL_TZ, bits: int | None = DEFAULT_BITS) -> DataFrame:
    """Distinct (product id, name, type) sold to individual customers in the period.

    Name and type come from the product dimension alone, so the lines are first reduced to
    their distinct product ids (map-side partial aggregation) and the dimension is joined to
    that small set instead of to every line; the final DISTINCT keeps the bag semantics of
    duplicate dimension rows."""
    lines = _lines_of_period(inp, inp.order_item.where(F.col("action_cd").isin(R.ADD, R.DELETE)), start, tz, bits)
    subs = individual_subscribers(inp).select(F.col("subscriberid").alias("_sub_id"))
    orders = orders_in_scope(inp, start, tz).select(F.col("row_id").alias("_ord_id"))
    # the subscriber and order joins only filter (the result is DISTINCT): semi joins
    sold = (
        lines.join(orders, F.col("order_id") == F.col("_ord_id"), "left_semi")
        .join(subs, F.col("serv_accnt_id") == F.col("_sub_id"), "left_semi")
        .select("prod_id")
        .distinct()
    )
    prod = inp.dim_product.select(
        F.col("productid").alias("_p_id"), F.col("productname").alias("product"),
        F.col("service_type").alias("product_type"),
    )
    return (
        sold.join(prod, F.col("prod_id") == F.col("_p_id"), "left")
        .select(F.col("prod_id").alias("productid"), "product", "product_type")
        .distinct()
    )


def latest_service_dates(inp: Inputs, lines: DataFrame | None = None, bits: int | None = DEFAULT_BITS) -> DataFrame:
    """Latest version of every order line's service dates (NULL update times last).

    With ``lines`` (row_id), versions of other lines are dropped where they are read, but for a few: the history has all
    lines that ever were, a report those of a period."""
    versions = inp.order_item_om
    if lines is not None and bits is not None:
        versions = reduced_to_keys(versions, "row_id", lines, "row_id", bits)
    return latest_per_key(
        versions,
        ["row_id"],
        [
            F.col("last_upd").desc_nulls_last(),
            F.col("service_start_dt").asc_nulls_last(),
            F.col("service_end_dt").asc_nulls_last(),
        ],
    )


def period_lines(inp: Inputs, start: str, tz: str = LOCAL_TZ, bits: int | None = DEFAULT_BITS) -> DataFrame:
    """Completed Add and Delete lines that may be of an order of the period."""
    lines = inp.order_item.where((F.col("status_cd") == R.COMPLETE) & F.col("action_cd").isin(R.ADD, R.DELETE))
    return _lines_of_period(inp, lines, start, tz, bits)


def _lines_of_period(inp: Inputs, lines: DataFrame, start: str, tz: str, bits: int) -> DataFrame:
    """Lines have no date.  Those of other orders are dropped where they are read, but for a few, by a bitmap of the period's
    order ids, so that the join with the orders shuffles lines of the period instead of all there ever were."""
    return lines if bits is None else reduced_to_keys(lines, "order_id", orders_in_scope(inp, start, tz), "row_id", bits)


def base(inp: Inputs, start: str, tz: str = LOCAL_TZ, bits: int | None = DEFAULT_BITS) -> DataFrame:
    """``bits``: of the bitmaps of the period's orders and lines (``operators.key_filter``); None: no bitmaps."""
    kept = period_lines(inp, start, tz, bits)
    lines = kept.select(
        "row_id", "order_id", "prod_id", "serv_accnt_id",
        F.col("net_pri").alias("netprice"),
        F.col("status_cd").alias("orderitemstatus"),
        F.col("action_cd").alias("actioncd"),
        F.col("par_order_item_id").alias("parentorderitemrowid"),
        "asset_integ_id",
    )
    orders = orders_in_scope(inp, start, tz).select(
        F.col("row_id").alias("_ord_id"),
        F.col("order_num").alias("orderid"),
        F.col("created").alias("contractstartdate"),
        F.col("x_sub_type").alias("ordertype"),
        F.col("status_cd").alias("orderstatus"),
        F.col("created_by").alias("_ord_user"),
    )
    usr = inp.dim_user.select(F.col("userid").alias("_usr_id"), "login", "username")
    ord2 = inp.order_ext_2.select(
        F.col("row_id").alias("_ord2_id"),
        F.col("x_shop_id").alias("shopname"),
        F.col("x_mena_user").alias("menaidentifier"),
        "x_channel",
    )
    # the order's extension and user are joined at order grain, before the lines multiply the rows
    orders = orders.join(ord2, F.col("_ord_id") == F.col("_ord2_id"), "left").join(
        usr, F.col("_ord_user") == F.col("_usr_id"), "left"
    )
    om = latest_service_dates(inp, kept.select("row_id"), bits).select(
        F.col("row_id").alias("_om_id"),
        F.col("service_start_dt").alias("servicestartdate"),
        F.col("service_end_dt").alias("serviceenddate"),
    )
    prod = inp.product_crm.select(
        F.col("row_id").alias("_prod_id"),
        F.col("name").alias("product"),
        F.col("body_style_cd").alias("crmproducttype"),
        F.col("part_num").alias("productpartnumber"),
    )
    article = inp.dim_article.where(F.col("level3") != R.EXCLUDE).select(
        F.col("productid").alias("_art_id"),
        "level3", "level4", F.col("facevalue").cast("double").alias("facevalue"), "level3_order", "description",
    )
    # Join order: the orders of the period come first, as lines have no date of their own and nothing
    # else cuts their history as much; then the subscribers, and last the joins on the product and on
    # the line.  Article and product are joined to each other first, so that the lines are joined on the product
    # once, by an exchange of its own: a hot product is split without any setting.
    scoped = individual_lines(inp, lines.join(orders, F.col("order_id") == F.col("_ord_id"), "inner"))
    goods = article.join(prod, F.col("_art_id") == F.col("_prod_id"), "left")
    joined = join_on_own_exchange(scoped, goods, "prod_id", "_art_id").join(om, F.col("row_id") == F.col("_om_id"), "left")
    return joined.select(
        local_time("contractstartdate", tz).alias("transactiondate"),
        "row_id", "subscriberid", "customername", "connectiontype", "linecategory", "msisdn", "orderid",
        R.transaction_type_level1("ordertype").alias("transactiontype_level1"),
        F.lit(R.SERVICE_PLAN).alias("transactionsubtype_level2"),
        "contractstartdate",
        F.col("prod_id").alias("productrowid"),
        "product", "crmproducttype", "productpartnumber", "netprice", "ordertype", "orderitemstatus", "actioncd",
        "orderstatus", "servicestartdate",
        contract_months("serviceenddate", "contractstartdate").alias("duration"),
        "serviceenddate", "serviceaccountnumber", "billingaccountnumber",
        F.col("row_id").alias("orderitemrowid"),
        "parentorderitemrowid", "asset_integ_id", "login", "username", "shopname", "menaidentifier", "x_channel",
        "level3", "level4", "facevalue", "level3_order", "description",
        R.hw_flag("level3").alias("hw_flag"),
    )


def order_flags(base_df: DataFrame) -> DataFrame:
    """orderid -> which of the four kinds its lines have; label and set of kinds both come from these flags."""
    return presence_flags(base_df.where(F.col("level3").isin(*R.KINDS)), "orderid", "level3", MIX_FLAGS)


def order_mix(base_df: DataFrame) -> DataFrame:
    """orderid -> product-mix label over all the order's lines of the four kinds."""
    flags = order_flags(base_df)
    return flags.select("orderid", R.order_mix(*[F.col(f) for f in MIX_FLAGS]).alias("level3_category_case"))


def with_order_flags(lines: DataFrame, base_df: DataFrame) -> DataFrame:
    """``lines`` with the flags of their order (NULL: an order without lines of the four kinds, or no order)."""
    flags = order_flags(base_df).withColumnRenamed("orderid", "_flags_order")
    return join_on_own_exchange(lines, flags, "orderid", "_flags_order", "left").drop("_flags_order")


def added_with_removed(lines: DataFrame) -> DataFrame:
    """Add lines of change orders x Delete lines of the same order and hardware flag: every pair."""
    adds = lines.where((F.col("actioncd") == R.ADD) & (F.col("ordertype") != R.PROVIDE))
    return pair_with_removed(adds, lines.where(F.col("actioncd") == R.DELETE), ["orderid", "hw_flag"], OLD_COLUMNS)


def paired_and_provide(base_df: DataFrame) -> DataFrame:
    """The pairs, then every line of new-connection (Provide) orders with empty old_* columns."""
    kept = base_df.where(F.col("level3") != R.EXCLUDE)
    paired = added_with_removed(kept)
    provide = kept.where(F.col("ordertype") == R.PROVIDE).select(
        "*",
        _null("string").alias("old_product_name"),
        F.lit(0.0).alias("old_netprice"),
        _null("timestamp_ntz").alias("old_serviceenddate"),
        _null("string").alias("old_level3"),
        _null("string").alias("old_level4"),
        F.lit(0.0).alias("old_facevalue"),
    )
    cols = ENRICHED_COLUMNS[1:]
    return paired.select(*cols).unionByName(provide.select(*cols))


def delete_enriched(base_df: DataFrame) -> DataFrame:
    mix = F.coalesce(R.order_mix(*[F.col(f) for f in MIX_FLAGS]), F.lit(R.MISC))
    lines = with_order_flags(paired_and_provide(base_df), base_df)
    return lines.select(mix.alias("level3_category_case"), *ENRICHED_COLUMNS[1:])


def _level1_rule(level3: Column) -> Column:
    return (
        F.when(level3 == R.DEVICE, R.level1_device())
        .when(level3 == R.ACCESSORIES, R.level1_accessories())
        .when(level3 == R.SERVICE, R.level1_service())
        .when(level3 == R.OTHER, R.level1_other())
    )


EXCLUSIVE_FLAGS = {  # a Service line needs no A/D/O line in its order; an Other line no A/D/S line
    R.SERVICE: (R.ACCESSORIES, R.DEVICE, R.OTHER),
    R.OTHER: (R.ACCESSORIES, R.DEVICE, R.SERVICE),
}


def level1(de: DataFrame) -> DataFrame:
    """Movement type per enriched line, in one pass over the four kinds.

    Device and accessory lines always qualify.  A service line qualifies only if its order
    has no device/accessory/other line (``orderid NOT IN (...)``), an other line only if its
    order has no device/accessory/service line.  Both lists come from one per-order flag
    aggregate (partial aggregation before the shuffle, one narrow row per order).  The NULL
    cases of NOT IN need two global facts per list (is it empty, does it hold a NULL
    orderid); they come from one scalar aggregate subquery, evaluated once.
    """
    lists = {k: F.col("level3").isin(*v) for k, v in EXCLUSIVE_FLAGS.items()}
    flags = de.groupBy(F.col("orderid").alias("_fl_order")).agg(
        *[F.bool_or(cond).alias(f"_in_{k}") for k, cond in lists.items()]
    )
    withf = de.join(flags, F.col("orderid") == F.col("_fl_order"), "left")
    facts = de.agg(
        F.struct(
            *[F.coalesce(F.bool_or(cond), F.lit(False)).alias(f"any_{k}") for k, cond in lists.items()],
            *[F.coalesce(F.bool_or(cond & F.col("orderid").isNull()), F.lit(False)).alias(f"null_{k}")
              for k, cond in lists.items()],
        )
    ).scalar()

    def passes(kind: str) -> Column:
        has_null, non_empty = facts.getField(f"null_{kind}"), facts.getField(f"any_{kind}")
        return ~has_null & (
            (F.col("orderid").isNotNull() & ~F.coalesce(F.col(f"_in_{kind}"), F.lit(False)))
            | (F.col("orderid").isNull() & ~non_empty)
        )

    level3 = F.col("level3")
    keep = level3.isin(R.DEVICE, R.ACCESSORIES) | ((level3 == R.SERVICE) & passes(R.SERVICE)) | (
        (level3 == R.OTHER) & passes(R.OTHER)
    )
    return (
        withf.where(keep)
        .withColumn("daysdiff", days_between("old_serviceenddate", "transactiondate"))
        .select("daysdiff", _level1_rule(level3).alias("level1"), *ENRICHED_COLUMNS)
    )


def level1_by_branches(de: DataFrame) -> DataFrame:
    """The same result written as four filtered branches and UNION ALL (NOT IN as anti join)."""
    from orderlens.operators import not_in

    dd = de.withColumn("daysdiff", days_between("old_serviceenddate", "transactiondate"))

    def branch(df: DataFrame, rule: Column) -> DataFrame:
        return df.select("daysdiff", rule.alias("level1"), *ENRICHED_COLUMNS)

    level3 = F.col("level3")
    device = branch(dd.where(level3 == R.DEVICE), R.level1_device())
    acc = branch(dd.where(level3 == R.ACCESSORIES), R.level1_accessories())
    svc = not_in(dd.where(level3 == R.SERVICE), "orderid",
                 de.where(level3.isin(*EXCLUSIVE_FLAGS[R.SERVICE])), "orderid")
    oth = not_in(dd.where(level3 == R.OTHER), "orderid",
                 de.where(level3.isin(*EXCLUSIVE_FLAGS[R.OTHER])), "orderid")
    return union_positional(device, acc, branch(svc, R.level1_service()), branch(oth, R.level1_other()))


def order_level1(lvl1: DataFrame) -> DataFrame:
    """``SELECT DISTINCT orderid, level1``.

    Written as a per-order set (at most the dozen Level1 labels, so bounded per order)
    and exploded back: the aggregate is keyed by orderid alone, so its output is already
    hash-partitioned the way the join on orderid needs it (a plain DISTINCT would shuffle by
    (orderid, level1) and then again by orderid).  The struct keeps a NULL label as a value.
    """
    tags = lvl1.groupBy("orderid").agg(F.collect_set(F.struct("level1")).alias("_tags"))
    return tags.select("orderid", F.explode("_tags").alias("_tag")).select("orderid", "_tag.level1")


def pos_by_journal(inp: Inputs) -> DataFrame:
    """POS order detail -> gross sale by journal, keyed by CRM order.

    Joined on the POS side first ((a LEFT JOIN p) LEFT JOIN t ON p.j = t.j equals
    a LEFT JOIN (p LEFT JOIN t), as the second condition rejects NULL p rows), so the wide
    report rows are exchanged once by orderid for all order-keyed joins."""
    sale = inp.pos_sale.select(
        F.col("journal_id").alias("_tr_journal"),
        F.col("agentid").alias("agent_pos"),
        F.col("shop").alias("shop_pos"),
        F.col("agent_firstname").alias("agent_name_pos"),
    )
    return (
        inp.pos_order.join(sale, F.col("journal_id") == F.col("_tr_journal"), "left")
        .select(F.col("crm_order").alias("_pos_order"), "agent_pos", "shop_pos", "agent_name_pos")
    )


def dealers(inp: Inputs) -> DataFrame:
    """order_num -> dealer for completed dealer orders (comma join of order and extension)."""
    head = inp.order_head.where(F.col("x_sub_status") == R.COMPLETE).select(
        F.col("row_id").alias("_dh_id"), F.col("order_num").alias("_dealer_order")
    )
    ext = inp.order_ext_x.where(F.col("attrib_45").isNotNull()).select(
        F.col("row_id").alias("_dx_id"), F.col("attrib_45").alias("dealer")
    )
    return head.join(ext, F.col("_dh_id") == F.col("_dx_id"), "inner").select("_dealer_order", "dealer")


def pos_within_window(lines: DataFrame, inp: Inputs, tz: str = LOCAL_TZ, start: str | None = None) -> DataFrame:
    """Every POS sale of the line's subscriber less than 600 minutes from the order time.

    The order time is local already and is shifted to local time once more before the
    comparison (the report compares it this way); the gap is in whole seconds.  Where all lines
    are of ``start`` or later, sales more than a day before it can't match: a zone is at most 12
    hours behind, the gap under 10.  That bound reaches the scan of the sales.
    """
    sales = inp.pos_sale
    if start is not None:
        bound = F.lit(start).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(1))
        sales = sales.where(F.col("transaction_date") >= bound)
    sale = sales.select(
        F.col("subscriberid").alias("_ps_sub"),
        F.col("transaction_date").alias("pos_timestamp"),
        F.col("agentid").alias("agent_pos_subid"),
        F.col("shop").alias("shop_pos_subid"),
    )
    return left_join_within(
        lines,
        sale,
        [("subscriberid", "_ps_sub")],
        epoch_seconds(local_time("transactiondate", tz)),
        epoch_seconds("pos_timestamp"),
        POS_WINDOW_SECONDS,
    ).drop("_ps_sub")


def by_order(orders: DataFrame, lvl1: DataFrame, inp: Inputs) -> DataFrame:
    """What the report adds to each order of ``orders`` (orderid): tags, sales by journal, dealer, in every combination."""
    tags = order_level1(lvl1).select(F.col("orderid").alias("_tag_order"), "level1")
    ids = orders.where(F.col("orderid").isNotNull()).select(F.col("orderid").alias("_by_order")).distinct()
    return (
        ids.join(tags, F.col("_by_order") == F.col("_tag_order"), "left")
        .join(pos_by_journal(inp), F.col("_by_order") == F.col("_pos_order"), "left")
        .join(dealers(inp), F.col("_by_order") == F.col("_dealer_order"), "left")
        .drop("_tag_order", "_pos_order", "_dealer_order")
    )


def report(de: DataFrame, lvl1: DataFrame, inp: Inputs, tz: str = LOCAL_TZ, start: str | None = None) -> DataFrame:
    """The three joins on the order are made at order grain, a row for each order and match; the wide lines meet their
    result in one join, whose hot orders are split and which lines without an order bypass."""
    joined = join_on_own_exchange(de, by_order(de, lvl1, inp), "orderid", "_by_order", "left").drop("_by_order")
    joined = pos_within_window(joined, inp, tz, start)
    return joined.select(
        "level1",
        R.level2().alias("level2"),
        R.shop_crm().alias("shop_crm"),
        *ENRICHED_COLUMNS,
        sales_date("transactiondate").alias("salesdate"),
        sales_hour("transactiondate").alias("saleshour"),
        "agent_pos", "shop_pos", "agent_name_pos", "agent_pos_subid", "shop_pos_subid", "dealer", "pos_timestamp",
    ).distinct()


def cash_only_sales(inp: Inputs, start: str) -> DataFrame:
    """Cash article groups sold at POS since ``start`` without a POS order-detail record.

    The composite key ``concat(nvl(articleno,'x'), nvl(journal_id,'x'))`` is never NULL, so
    ``NOT IN`` equals a plain left anti join here (no NULL cases to handle).
    """
    sales = inp.pos_sale.where(
        F.col("articlegroup").isin(*R.CASH_ARTICLE_GROUPS) & on_or_after(F.to_date("transaction_date"), start)
    ).withColumn("_cash_key", R.null_marked_key("articleno", "journal_id"))
    detail = inp.pos_order.where(on_or_after(F.to_date("order_completion_date"), start)).select(
        R.null_marked_key("articleno", "journal_id").alias("_detail_key")
    )
    return sales.join(detail, F.col("_cash_key") == F.col("_detail_key"), "left_anti").drop("_cash_key")


def cash_rows(inp: Inputs, start: str) -> DataFrame:
    """Cash-only sales laid out as report rows (position-for-position with REPORT_COLUMNS).

    Text fillers stay ''; date, time and number positions get typed NULLs or 0.
    """
    e = F.lit("")
    return cash_only_sales(inp, start).select(
        F.lit(R.CASH).alias("level1"),
        F.col("articlegroup").alias("level2"),
        e.alias("shop_crm"),
        e.alias("level3_category_case"),
        F.col("cash_day").alias("transactiondate"),
        "subscriberid",
        e.alias("customername"),
        e.alias("linecategory"),
        "msisdn",
        F.col("journal_id").alias("orderid"),
        _null("timestamp_ntz").alias("contractstartdate"),
        F.col("articlename").alias("product"),
        e.alias("old_product_name"),
        R.whole_amount("item_total_amount").cast("double").alias("netprice"),
        F.lit(0.0).alias("old_netprice"),
        e.alias("ordertype"),
        e.alias("actioncd"),
        _null("timestamp_ntz").alias("servicestartdate"),
        F.col("transaction_amount").cast("double").alias("duration"),
        _null("timestamp_ntz").alias("serviceenddate"),
        _null("timestamp_ntz").alias("old_serviceenddate"),
        e.alias("login"),
        e.alias("username"),
        e.alias("shopname"),
        e.alias("x_channel"),
        e.alias("level3"),
        e.alias("old_level3"),
        e.alias("level4"),
        e.alias("old_level4"),
        F.lit(0.0).alias("facevalue"),
        F.lit(0.0).alias("old_facevalue"),
        F.lit(0).alias("level3_order"),
        e.alias("description"),
        sales_date("cash_day").alias("salesdate"),
        sales_hour("cash_day").alias("saleshour"),
        F.col("agentid").alias("agent_pos"),
        F.col("shop").alias("shop_pos"),
        F.col("agent_firstname").alias("agent_name_pos"),
        e.alias("agent_pos_subid"),
        e.alias("shop_pos_subid"),
        e.alias("dealer"),
        _null("timestamp_ntz").alias("pos_timestamp"),
    )


def report_with_cash(rpt: DataFrame, inp: Inputs, start: str) -> DataFrame:
    """UNION ALL of report rows and cash-only rows (42 columns, by position)."""
    return union_positional(rpt.select(*REPORT_COLUMNS), cash_rows(inp, start))


def report_cash(rpt: DataFrame, inp: Inputs, start: str) -> DataFrame:
    u = report_with_cash(rpt, inp, start)
    st = inp.dim_sub_type.select(F.col("subscriberid").alias("_st_sub"), "subscribertypename")
    return u.join(st, F.col("subscriberid") == F.col("_st_sub"), "left").select(
        *REPORT_COLUMNS, R.shop_name_combined().alias("shopnamecombined"), "subscribertypename"
    )


def run_chain(inp: Inputs, start: str, tz: str = LOCAL_TZ, bits: int | None = DEFAULT_BITS,
              store: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All stages chained.  ``store(name, df)`` may materialise the two stages that are read
    several times (base, delete_enriched) and return the re-read DataFrame; without it the
    chain stays lazy (see ``plans.pipeline`` for the run that writes every stage)."""
    keep = store or (lambda _name, df: df)
    b = keep("base", base(inp, start, tz, bits))
    de = keep("delete_enriched", delete_enriched(b))
    l1 = level1(de)
    rpt = report(de, l1, inp, tz, start)
    return {
        "unique_products": unique_products(inp, start, tz, bits),
        "base": b,
        "delete_enriched": de,
        "level1": l1,
        "report": rpt,
        "report_cash": report_cash(rpt, inp, start),
    }
