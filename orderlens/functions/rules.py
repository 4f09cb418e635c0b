"""Classification rules of the sales report as Column expressions.

Every rule is a searched CASE: the first arm whose condition is TRUE wins, a NULL condition
counts as not true, and a rule without ELSE yields NULL.  Arguments are column names or
Columns, so the same rule serves the stage code, the single-operator queries and unit tests.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: labels and codes the report compares with or emits --------------------
PROVIDE, MODIFY, MIGRATION = "Provide", "Modify", "Migration"
ORDER_TYPES = (PROVIDE, MODIFY, MIGRATION)
ADD, DELETE = "Add", "Delete"
COMPLETE, INDIVIDUAL = "Complete", "Individual"
SERVICE, DEVICE, ACCESSORIES, OTHER, EXCLUDE = "Service", "Device", "Accessories", "Other", "Exclude"
KINDS = (SERVICE, ACCESSORIES, DEVICE, OTHER)
HW = "HW"
NEW = "New"
SERVICE_PLAN = "ServicePlan"
MIX_SERVICE_DEVICE = "Service & Device"
MIX_SERVICE_DEVICE_ACC = "Service, Device & Accessories"
MIX_SERVICE_ACC = "Service & Accessories"
MIX_SERVICE_DEVICE_OTHERS = "Service, Device & Others"
MISC = "Misc"
RENEWAL, UPGRADE, DOWNGRADE, CHECK = "Renewal", "Upgrade", "Downgrade", "check"
PROVIDE_OLD_DEVICE = "Provide with old device to be investigated"
PROVIDE_OLD_ACC = "Provide with old acc to be investigated"
TERMINATION, RETENTION = "Termination Request", "Retention"
UPGRADE_MIGRATION = "Upgrade Migration"
SAME_FACE_VALUE = "Same face value"
RENEWAL_WINDOW_DAYS = 90
TEMP_WORD, PREPAID_WORD = "temp", "prepaid"
CHILD_SIM_LEVEL4, CHILD_SIM = "ChildSim", "Child SIM"
PRE2POST, POST2POST, CONTRACTUAL, SIM_ONLY = "Pre2Post", "Post2Post", "Contractual", "SIM only"
ECOMMERCE, MOBILE_APP = "eCommerce", "mapp"
E_SHOP, APP, OUTBOUND_NVL = "E-Shop", "App", "Outbound_NVL"
CASH = "Cash"
CASH_ARTICLE_GROUPS = ("ETOPUP", "Recharge Cards", "Accessories")
NULL_KEY_MARK = "x"
# -------------------------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_ci(c: str | Column, word: str) -> Column:
    """``lower(c) LIKE '%word%'`` (NULL stays NULL)."""
    return F.lower(_c(c)).contains(word)


def transaction_type_level1(ordertype: str | Column = "ordertype") -> Column:
    return F.when(_c(ordertype) == PROVIDE, F.lit(NEW))


def hw_flag(level3: str | Column = "level3") -> Column:
    """Devices and accessories pair with each other as hardware; other kinds keep their name."""
    return F.when(_c(level3).isin(ACCESSORIES, DEVICE), F.lit(HW)).otherwise(_c(level3))


#: the initials of the kinds that an order holds -> its label; any other set is ``MISC``
MIX_LABELS = {
    "S": SERVICE,
    "D": DEVICE,
    "A": ACCESSORIES,
    "O": OTHER,
    "SD": MIX_SERVICE_DEVICE,
    "SA": MIX_SERVICE_ACC,
    "SDA": MIX_SERVICE_DEVICE_ACC,
    "SDO": MIX_SERVICE_DEVICE_OTHERS,
}


def order_mix(has_s: Column, has_d: Column, has_a: Column, has_o: Column) -> Column:
    """Product mix of an order, looked up by the set of its kinds (NULL flags: order not found -> Misc)."""
    kinds = F.concat_ws("", *[F.when(flag, F.lit(initial)) for flag, initial in zip((has_s, has_d, has_a, has_o), "SDAO")])
    labels = F.create_map(*[F.lit(x) for pair in MIX_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, kinds), F.lit(MISC))


def face_value_delta(facevalue: str | Column = "facevalue", old_facevalue: str | Column = "old_facevalue") -> Column:
    """``nvl(facevalue,0) - nvl(old_facevalue,0)``."""
    return F.coalesce(_c(facevalue), F.lit(0)) - F.coalesce(_c(old_facevalue), F.lit(0))


def in_renewal_window(daysdiff: str | Column) -> Column:
    return _c(daysdiff).between(-RENEWAL_WINDOW_DAYS, RENEWAL_WINDOW_DAYS)


def outside_renewal_window(daysdiff: str | Column) -> Column:
    return (_c(daysdiff) > RENEWAL_WINDOW_DAYS) | (_c(daysdiff) < -RENEWAL_WINDOW_DAYS)


def level1_hardware(provide_with_old_label: str, ordertype="ordertype", old_product_name="old_product_name",
                    daysdiff="daysdiff") -> Column:
    """Level1 of device / accessory lines: renewal inside +-90 days of the old contract end."""
    not_provide, is_provide = _c(ordertype) != PROVIDE, _c(ordertype) == PROVIDE
    had_old, no_old = _c(old_product_name).isNotNull(), _c(old_product_name).isNull()
    return (
        F.when(not_provide & had_old & in_renewal_window(daysdiff), F.lit(RENEWAL))
        .when(not_provide & had_old & outside_renewal_window(daysdiff), F.lit(UPGRADE))
        .when(not_provide & no_old, F.lit(UPGRADE))
        .when(is_provide & had_old, F.lit(provide_with_old_label))
        .when(is_provide & no_old, F.lit(NEW))
        .otherwise(F.lit(CHECK))
    )


def level1_device(**cols) -> Column:
    return level1_hardware(PROVIDE_OLD_DEVICE, **cols)


def level1_accessories(**cols) -> Column:
    return level1_hardware(PROVIDE_OLD_ACC, **cols)


def level1_plan(migration_label: str, product="product", old_product_name="old_product_name",
                ordertype="ordertype", facevalue="facevalue", old_facevalue="old_facevalue",
                serviceenddate="serviceenddate", daysdiff="daysdiff") -> Column:
    """Level1 of service-plan and other lines, driven by the face-value change."""
    not_provide = _c(ordertype) != PROVIDE
    delta = face_value_delta(facevalue, old_facevalue)
    has_end = _c(serviceenddate).isNotNull()
    return (
        F.when(contains_ci(product, TEMP_WORD), F.lit(TERMINATION))
        .when(contains_ci(old_product_name, TEMP_WORD), F.lit(RETENTION))
        .when(_c(ordertype) == MIGRATION, F.lit(migration_label))
        .when(not_provide & (delta < 0) & has_end, F.lit(UPGRADE))
        .when(not_provide & (delta < 0), F.lit(DOWNGRADE))
        .when(not_provide & (delta > 0), F.lit(UPGRADE))
        .when(not_provide & _c(old_product_name).isNotNull() & in_renewal_window(daysdiff), F.lit(RENEWAL))
        .when(not_provide & (delta == 0) & has_end, F.lit(UPGRADE))
        .when(not_provide & (delta == 0), F.lit(SAME_FACE_VALUE))
        .when(_c(ordertype) == PROVIDE, F.lit(NEW))
        .otherwise(F.lit(CHECK))
    )


def level1_service(**cols) -> Column:
    return level1_plan(UPGRADE, **cols)


def level1_other(**cols) -> Column:
    return level1_plan(UPGRADE_MIGRATION, **cols)


def level2(level4="level4", level1="level1", ordertype="ordertype", product="product", facevalue="facevalue",
           old_facevalue="old_facevalue", serviceenddate="serviceenddate",
           level3_category_case="level3_category_case") -> Column:
    """Contract kind: child SIM, prepaid-to-postpaid, postpaid upgrade, contractual or SIM only."""
    migration = _c(ordertype) == MIGRATION
    no_end = _c(serviceenddate).isNull()
    return (
        F.when(_c(level4) == CHILD_SIM_LEVEL4, F.lit(CHILD_SIM))
        .when((_c(level1) == UPGRADE) & migration & ~contains_ci(product, PREPAID_WORD), F.lit(PRE2POST))
        .when((_c(level1) == DOWNGRADE) & migration & contains_ci(product, PREPAID_WORD), F.lit(PRE2POST))
        .when((_c(level1) == UPGRADE) & (face_value_delta(facevalue, old_facevalue) > 0) & no_end, F.lit(POST2POST))
        # an open end makes a service-only order SIM only, and one whose mix isn't known
        .when(no_end & (F.coalesce(_c(level3_category_case), F.lit(SERVICE)) == SERVICE), F.lit(SIM_ONLY))
        .otherwise(F.lit(CONTRACTUAL))
    )


def shop_crm(x_channel="x_channel", shopname="shopname") -> Column:
    return (
        F.when(_c(x_channel) == ECOMMERCE, F.lit(E_SHOP))
        .when(_c(x_channel) == MOBILE_APP, F.lit(APP))
        .otherwise(F.coalesce(_c(shopname), F.lit(OUTBOUND_NVL)))
    )


def shop_name_combined(username="username", shop_pos="shop_pos", login="login", shop_crm_col="shop_crm",
                       shop_pos_subid="shop_pos_subid") -> Column:
    """Selling shop: the CRM login for walk-ins without a user or POS shop, online channels as is,
    otherwise the POS shop by journal, then by subscriber, then the CRM shop."""
    return (
        F.when(_c(username).isNull() & _c(shop_pos).isNull(), _c(login))
        .when(_c(shop_crm_col).isin(E_SHOP, APP), _c(shop_crm_col))
        .otherwise(F.coalesce(_c(shop_pos), _c(shop_pos_subid), _c(shop_crm_col)))
    )


def null_marked_key(*cols: str | Column) -> Column:
    """``concat(nvl(a,'x'), nvl(b,'x'))``: a never-NULL composite key without delimiter."""
    return F.concat(*[F.coalesce(_c(c), F.lit(NULL_KEY_MARK)) for c in cols])


def whole_amount(amount: str) -> Column:
    """The whole part of an amount, NULL where it is no number (text) or too large."""
    return F.col(amount).try_cast("double").try_cast("int")
