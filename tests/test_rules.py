"""Classification rules on hand-made rows (FIXTURES.md section D)."""

import datetime as dt
import itertools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import rules as R
from orderlens.functions.timefn import contract_months, local_date, local_time


def _rows(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_order_mix_truth_table(spark):
    """T1: all 16 subsets of the four kinds -> 8 named labels, everything else Misc."""
    kinds = ["s", "d", "a", "o"]
    rows = [tuple(bool(k in sub) for k in kinds) for n in range(5) for sub in itertools.combinations(kinds, n)]
    rows.append((None, None, None, None))  # order without any line of the four kinds
    df = _rows(spark, "s boolean, d boolean, a boolean, o boolean", rows)
    got = {tuple(r[:4]): r[4] for r in df.select("*", R.order_mix(*[F.col(k) for k in kinds]).alias("m")).collect()}
    expected_named = {
        (True, False, False, False): "Service",
        (True, True, False, False): "Service & Device",
        (True, True, True, False): "Service, Device & Accessories",
        (True, False, True, False): "Service & Accessories",
        (True, True, False, True): "Service, Device & Others",
        (False, False, False, True): "Other",
        (False, True, False, False): "Device",
        (False, False, True, False): "Accessories",
    }
    for key, label in got.items():
        assert label == expected_named.get(key, "Misc"), key
    # 7 unnamed non-empty subsets, the empty set (all false) and the order without flags (NULL)
    assert sum(1 for v in got.values() if v == "Misc") == 9


def test_hw_flag_and_new(spark):
    df = _rows(spark, "level3 string, ordertype string",
               [("Device", "Provide"), ("Accessories", "Modify"), ("Service", None), (None, "Migration")])
    got = df.select(R.hw_flag().alias("h"), R.transaction_type_level1().alias("t")).collect()
    assert [tuple(r) for r in got] == [("HW", "New"), ("HW", None), ("Service", None), (None, None)]


def test_level1_hardware_window_and_check(spark):
    """T8: -91/-90/0/90/91 days; T6: old product present but no old end date -> 'check';
    T12: Provide with old product; T15: no old product -> Upgrade."""
    schema = "ordertype string, old_product_name string, daysdiff int"
    rows = [("Modify", "x", d) for d in (-91, -90, 0, 90, 91)] + [
        ("Modify", "x", None),  # T6
        ("Provide", "x", None),  # T12
        ("Provide", None, None),
        ("Modify", None, 5),  # T15
    ]
    df = _rows(spark, schema, rows)
    dev = [r[0] for r in df.select(R.level1_device()).collect()]
    acc = [r[0] for r in df.select(R.level1_accessories()).collect()]
    assert dev == ["Upgrade", "Renewal", "Renewal", "Renewal", "Upgrade", "check",
                   "Provide with old device to be investigated", "New", "Upgrade"]
    assert acc[6] == "Provide with old acc to be investigated"


def test_level1_plan_rules_in_order(spark):
    schema = ("product string, old_product_name string, ordertype string, facevalue double, "
              "old_facevalue double, serviceenddate timestamp, daysdiff int")
    t = dt.datetime(2024, 1, 1)
    rows = [
        ("Temp plan", "x", "Modify", 1.0, 2.0, t, 0),  # termination before anything else
        ("plan", "TEMP old", "Modify", 1.0, 2.0, t, 0),  # retention
        ("plan", None, "Migration", 1.0, 2.0, t, 0),  # migration
        ("plan", None, "Modify", 1.0, 2.0, t, 0),  # delta < 0 with end date -> Upgrade
        ("plan", None, "Modify", 1.0, 2.0, None, 0),  # delta < 0 -> Downgrade
        ("plan", None, "Modify", 3.0, None, None, 0),  # NULL old face value counts as 0 -> Upgrade
        ("plan", "old", "Modify", 2.0, 2.0, None, 10),  # delta 0, in window -> Renewal
        ("plan", None, "Modify", None, None, t, None),  # delta 0 with end date -> Upgrade
        ("plan", None, "Modify", None, 0.0, None, None),  # delta 0 -> Same face value
        ("plan", None, "Provide", 1.0, 0.0, None, None),  # Provide -> New
        ("plan", None, None, 1.0, 0.0, None, None),  # no order type -> check
    ]
    df = _rows(spark, schema, rows)
    svc = [r[0] for r in df.select(R.level1_service()).collect()]
    oth = [r[0] for r in df.select(R.level1_other()).collect()]
    assert svc == ["Termination Request", "Retention", "Upgrade", "Upgrade", "Downgrade", "Upgrade", "Renewal",
                   "Upgrade", "Same face value", "New", "check"]
    assert oth[2] == "Upgrade Migration" and oth[:2] == svc[:2] and oth[3:] == svc[3:]


def test_level2(spark):
    """Includes T12's hand-fed Downgrade + Migration + prepaid -> Pre2Post, and M18 (never NULL)."""
    schema = ("level4 string, level1 string, ordertype string, product string, facevalue double, "
              "old_facevalue double, serviceenddate timestamp, level3_category_case string")
    t = dt.datetime(2024, 1, 1)
    rows = [
        ("ChildSim", "Upgrade", "Migration", "plan", 0.0, 0.0, t, "Service"),
        (None, "Upgrade", "Migration", "plan", 0.0, 0.0, t, "Service"),
        (None, "Downgrade", "Migration", "Prepaid plan", 0.0, 0.0, t, "Service"),
        (None, "Upgrade", "Modify", "plan", 5.0, 1.0, None, "Service"),
        (None, "Renewal", "Modify", "plan", 0.0, 0.0, t, "Service"),
        (None, "Renewal", "Modify", "plan", 0.0, 0.0, None, "Misc"),
        (None, "Renewal", "Modify", "plan", 0.0, 0.0, None, "Service"),
        (None, "Upgrade", "Migration", None, 0.0, 0.0, None, "Service"),  # NULL product fails NOT LIKE
    ]
    got = [r[0] for r in _rows(spark, schema, rows).select(R.level2()).collect()]
    assert got == ["Child SIM", "Pre2Post", "Pre2Post", "Post2Post", "Contractual", "Contractual", "SIM only",
                   "SIM only"]


def test_shop_rules(spark):
    """T16: channel mapping, NULL shop fallback, combined shop name fallback order."""
    df = _rows(spark, "x_channel string, shopname string",
               [("eCommerce", "S1"), ("mapp", None), ("Retail", "S3"), ("Retail", None), (None, None)])
    assert [r[0] for r in df.select(R.shop_crm()).collect()] == ["E-Shop", "App", "S3", "Outbound_NVL",
                                                                   "Outbound_NVL"]
    schema = "username string, shop_pos string, login string, shop_crm string, shop_pos_subid string"
    rows = [
        (None, None, "login1", "E-Shop", "P2"),  # no user and no POS shop -> login, even online
        ("u", None, "login1", "App", "P2"),
        ("u", "P1", "login1", "CRM", "P2"),
        ("u", None, "login1", "CRM", "P2"),
        ("u", None, "login1", "CRM", None),
        ("", None, "", "", ""),  # a cash row: '' beats later shops (M11)
    ]
    got = [r[0] for r in _rows(spark, schema, rows).select(R.shop_name_combined()).collect()]
    assert got == ["login1", "App", "P1", "P2", "CRM", ""]


def test_null_marked_key_has_no_delimiter(spark):
    """M9: ('1','23') and ('12','3') give the same key; NULL becomes 'x'."""
    df = _rows(spark, "a string, b string", [("1", "23"), ("12", "3"), (None, "5"), (None, None)])
    assert [r[0] for r in df.select(R.null_marked_key("a", "b")).collect()] == ["123", "123", "x5", "xx"]


def test_time_helpers(spark):
    """T10: 20:59:59 and 21:00:00 UTC on the day before the start date are out / in (UTC+3)."""
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType())])
    rows = [(dt.datetime(2024, 1, 7, 20, 59, 59),), (dt.datetime(2024, 1, 7, 21, 0, 0),)]
    df = spark.createDataFrame(rows, schema)
    got = df.select(local_time("ts").alias("lt"), local_date("ts").alias("ld")).collect()
    assert got[0]["lt"] == dt.datetime(2024, 1, 7, 23, 59, 59) and got[0]["ld"] == dt.date(2024, 1, 7)
    assert got[1]["ld"] == dt.date(2024, 1, 8)


def test_contract_months_and_int_cast(spark):
    """round(days / 30.417) for whole days; T14: cast to int truncates toward zero."""
    schema = T.StructType([T.StructField("s", T.TimestampNTZType()), T.StructField("e", T.TimestampNTZType()),
                           T.StructField("amt", T.DoubleType())])
    rows = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1) + dt.timedelta(days=d), a)
            for d, a in ((-9, 12.9), (46, -12.9), (45, 0.5), (365, 99.99))]
    got = spark.createDataFrame(rows, schema).select(
        contract_months("e", "s").alias("m"), R.whole_amount("amt").alias("i")).collect()
    assert [r["m"] for r in got] == [0.0, 2.0, 1.0, 12.0]
    assert [r["i"] for r in got] == [12, -12, 0, 99]


def test_whole_amount_of_text(spark):
    """Text that is no number, and a number that is too large, give NULL instead of an error."""
    rows = [("12.9",), ("-0.5",), (" 7 ",), ("abc",), ("",), ("1e30",), (None,)]
    got = spark.createDataFrame(rows, "amt string").select(R.whole_amount("amt").alias("i")).collect()
    assert [r["i"] for r in got] == [12, 0, 7, None, None, None, None]
