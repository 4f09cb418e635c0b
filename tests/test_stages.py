"""Stage behaviour on hand-made rows (FIXTURES.md section D) and CSV source edge cases."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.plans import stages
from orderlens.sources import delimited
from orderlens.sources.adapter import FIXTURE_START, from_testdata


@pytest.fixture(scope="module")
def base_schema(spark, sf_dir):
    schema = stages.base(from_testdata(spark, sf_dir), FIXTURE_START).schema
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _base(spark, schema, rows):
    t = dt.datetime(2024, 1, 10, 12)
    full = []
    for r in rows:
        d = {f.name: None for f in schema.fields}
        d.update(transactiondate=t, subscriberid="1", level4="L4", hw_flag=None)
        d.update(r)
        if d["hw_flag"] is None and d.get("level3") is not None:
            d["hw_flag"] = "HW" if d["level3"] in ("Device", "Accessories") else d["level3"]
        full.append(Row(**{f.name: d[f.name] for f in schema.fields}))
    return spark.createDataFrame(full, schema)


def _line(order, action, level3, product, ordertype="Modify"):
    return dict(orderid=order, actioncd=action, level3=level3, product=product, ordertype=ordertype)


def test_pairing_rules(spark, base_schema):
    rows = [
        # T2: Add Device pairs with Delete Accessories through the HW flag
        _line("o2", "Add", "Device", "new phone"), _line("o2", "Delete", "Accessories", "old case"),
        # T3: Add without a Delete of the same flag is dropped
        _line("o3", "Add", "Service", "plan"), _line("o3", "Delete", "Device", "old phone"),
        # T4: Provide order keeps its Delete line, old_* empty, old prices 0
        _line("o4", "Delete", "Service", "gone", "Provide"), _line("o4", "Add", "Service", "plan", "Provide"),
        # T5: 2 Adds x 3 Deletes -> 6 rows
        *[_line("o5", "Add", "Service", f"a{i}") for i in range(2)],
        *[_line("o5", "Delete", "Service", f"d{i}") for i in range(3)],
    ]
    de = stages.delete_enriched(_base(spark, base_schema, rows))
    got = de.select("orderid", "actioncd", "product", "old_product_name", "old_netprice", "level3_category_case")
    by_order = {}
    for r in got.collect():
        by_order.setdefault(r["orderid"], []).append(r)
    assert [(r["product"], r["old_product_name"]) for r in by_order["o2"]] == [("new phone", "old case")]
    assert by_order["o2"][0]["level3_category_case"] == "Misc"  # Device + Accessories is not a named mix
    assert "o3" not in by_order
    assert sorted((r["actioncd"], r["old_product_name"], r["old_netprice"]) for r in by_order["o4"]) == [
        ("Add", None, 0.0), ("Delete", None, 0.0)]
    assert len(by_order["o5"]) == 6


def test_service_and_other_only_order_gets_no_level1(spark, base_schema):
    """T7: an order with Service and Other lines only is excluded by both NOT IN branches."""
    rows = [
        _line("o7", "Add", "Service", "plan"), _line("o7", "Delete", "Service", "old plan"),
        _line("o7", "Add", "Other", "sim"), _line("o7", "Delete", "Other", "old sim"),
        _line("o8", "Add", "Service", "plan"), _line("o8", "Delete", "Service", "old plan"),
    ]
    de = stages.delete_enriched(_base(spark, base_schema, rows))
    l1 = stages.level1(de)
    assert {r["orderid"] for r in l1.collect()} == {"o8"}
    assert sorted(tuple(r) for r in stages.level1_by_branches(de).collect()) == sorted(tuple(r) for r in l1.collect())


def test_level1_null_order_ids_follow_not_in(spark, base_schema):
    """M6: one NULL orderid among the Device/Accessories/Other lines empties the Service branch."""
    rows = [
        _line(None, "Add", "Device", "phone", "Provide"),
        _line("o9", "Add", "Service", "plan", "Provide"),
    ]
    de = stages.delete_enriched(_base(spark, base_schema, rows))
    kinds = sorted(r["level3"] for r in stages.level1(de).collect())
    assert kinds == ["Device"]
    assert sorted(r["level3"] for r in stages.level1_by_branches(de).collect()) == kinds


def test_csv_edge_cases(spark, tmp_path):
    """T13: short line -> NULL-filled, bad float -> NULL, empty fields -> NULL, a quote does not
    protect a comma (no quote character)."""
    p = tmp_path / "articles"
    p.mkdir()
    (p / "part-0.csv").write_text(
        "1,n1,c1,Service,L4,desc,10.5,3\n"
        "2,n2\n"
        "3,n3,c3,Device,L4,desc,abc,7\n"
        "4,,,,,,,\n"
        '5,"a,b",c5,Other,L4,desc,1.0,2\n'
    )
    rows = {r["productid"]: r for r in delimited.read_articles(spark, str(p)).collect()}
    assert rows["1"]["facevalue"] == 10.5 and rows["1"]["level3_order"] == 3
    assert rows["2"]["level3"] is None and rows["2"]["facevalue"] is None
    assert rows["3"]["facevalue"] is None and rows["3"]["level3_order"] == 7
    assert rows["4"]["productname"] is None and rows["4"]["level3"] is None
    assert rows["5"]["productname"] == '"a' and rows["5"]["commercialproductname"] == 'b"'


def test_invariants(spark, sf_dir):
    """level1 keys within delete_enriched; Level2 never NULL; report rows distinct;
    cash-only keys disjoint from POS order-detail keys."""
    from orderlens.functions import rules as R

    inp = from_testdata(spark, sf_dir)
    c = stages.run_chain(inp, FIXTURE_START)
    assert c["level1"].select("orderid").subtract(c["delete_enriched"].select("orderid")).count() == 0
    rpt = c["report"]
    assert rpt.where(F.col("level2").isNull()).count() == 0
    assert rpt.count() == rpt.distinct().count()
    cash = stages.cash_only_sales(inp, FIXTURE_START).select(R.null_marked_key("articleno", "journal_id").alias("k"))
    detail = inp.pos_order.select(R.null_marked_key("articleno", "journal_id").alias("k"))
    assert cash.join(detail, "k", "inner").count() == 0
    assert c["report_cash"].count() == rpt.count() + stages.cash_only_sales(inp, FIXTURE_START).count()
