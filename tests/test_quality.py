
from __future__ import annotations

import datetime as dt
import itertools
import math
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from salesmart.operators.quality import QUALITY_REASON, RULES, RULES_BY_REASON
from salesmart.plans.gold import metric_overview_daily
from salesmart.plans.silver import accepted_sales, build_silver_sales, checked_sales
from tests.fixtures import sale, tables


def _reasons(spark, rows, **kw) -> dict[str, str]:
    checked = checked_sales(tables(spark, rows, **kw))
    return {r["transaction_id"]: r[QUALITY_REASON] for r in checked.collect()}


def test_second_copy_of_a_line_is_quarantined(spark):
    # The source's own operator test: one row twice.
    silver, quarantine = build_silver_sales(tables(spark, [sale(), sale()]))
    assert silver.count() == 1
    assert quarantine.count() == 1
    assert quarantine.select(QUALITY_REASON).first()[QUALITY_REASON] == "duplicate_transaction"


def test_first_copy_invalid_still_makes_second_a_duplicate(spark):
    # The rank is taken before validity rules.
    rows = [sale(qty=0), sale()]
    checked = checked_sales(tables(spark, rows)).orderBy("_source_row_id").collect()
    assert [r[QUALITY_REASON] for r in checked] == ["invalid_quantity", "duplicate_transaction"]
    assert accepted_sales(tables(spark, rows)).count() == 0


def test_null_transaction_ids_form_one_group(spark):
    # All but the first NULL-id row are duplicates.
    rows = [sale(tid=None), sale(tid=None), sale(tid=None)]
    checked = checked_sales(tables(spark, rows))
    counts = {r[QUALITY_REASON]: r["n"] for r in checked.groupBy(QUALITY_REASON).agg(F.count("*").alias("n")).collect()}
    assert counts == {"": 1, "duplicate_transaction": 2}


def test_missing_and_unknown_product(spark):
    # Whitespace trims to "", NULL is missing; both also fail the join.
    rows = [sale(tid="A", product="   "), sale(tid="B", product=None), sale(tid="C", product="P999"),
            sale(tid="D", product=" P001 ")]
    r = _reasons(spark, rows)
    assert r["A"] == "missing_product_id|unknown_product"
    assert r["B"] == "missing_product_id|unknown_product"
    assert r["C"] == "unknown_product"
    assert r["D"] == ""


def test_tab_is_not_trimmed(spark):
    # Trim removes spaces only.
    r = _reasons(spark, [sale(tid="A", status="\tpaid"), sale(tid="B", status="  PAID ")])
    assert r == {"A": "invalid_order_status", "B": ""}


def test_null_channel_and_status_are_accepted(spark):
    # NOT IN on NULL is NULL, the rule does not fire.
    r = _reasons(spark, [sale(tid="A", channel=None), sale(tid="B", status=None),
                         sale(tid="C", channel="kiosk")])
    assert r == {"A": "", "B": "", "C": "invalid_channel"}


def test_boundaries_of_numeric_rules(spark):
    # Price 0 and quantity 0 are invalid, cost 0 is valid; negatives and NULLs.
    rows = [
        sale(tid="p0", price="0.00"), sale(tid="q0", qty=0), sale(tid="c0", ucost="0.00"),
        sale(tid="pn", price="-1.00"), sale(tid="cn", ucost="-0.01"), sale(tid="qn", qty=None),
        sale(tid="nn", net="-0.01"), sale(tid="nz", net="0.00"), sale(tid="nnull", net=None),
        sale(tid="pnull", price=None),
    ]
    r = _reasons(spark, rows)
    assert r == {
        "p0": "invalid_unit_price", "q0": "invalid_quantity", "c0": "",
        "pn": "invalid_unit_price", "cn": "invalid_unit_cost", "qn": "invalid_quantity",
        "nn": "invalid_net_revenue", "nz": "", "nnull": "", "pnull": "invalid_unit_price",
    }


def test_several_reasons_in_rule_order(spark):
    # Labels joined by | in the fixed rule order.
    row = sale(tid="X", product="P999", store="S999", day=dt.date(2030, 1, 1), qty=0,
               price="0.00", ucost="-1.00", channel="fax", status="lost", net="-5.00")
    assert _reasons(spark, [row])["X"] == (
        "unknown_product|unknown_store|missing_calendar_date|invalid_quantity|invalid_unit_price|"
        "invalid_unit_cost|invalid_channel|invalid_order_status|invalid_net_revenue"
    )


def test_dimension_row_with_null_attribute_counts_as_unknown(spark):
    # Detection is by attribute, not by key.
    products = [("P001", None, "kitchen", "B", Decimal("1.00"), Decimal("1.00"), dt.date(2024, 1, 1), True)]
    assert _reasons(spark, [sale()], product_rows=products)["T1"] == "unknown_product"


def test_duplicated_dimension_key_fans_out(spark):
    # Silver can hold more rows than the input.
    products = [
        ("P001", "Kettle", "kitchen", "B", Decimal("1.00"), Decimal("1.00"), dt.date(2024, 1, 1), True),
        ("P001", "Kettle 2", "kitchen", "B", Decimal("1.00"), Decimal("1.00"), dt.date(2024, 1, 1), True),
    ]
    silver, quarantine = build_silver_sales(tables(spark, [sale()], product_rows=products))
    assert silver.count() == 2 and quarantine.count() == 0


def test_realized_measures_zero_unless_paid(spark):
    # Cancelled and NULL status give 0.
    rows = [sale(tid="A"), sale(tid="B", status="cancelled"), sale(tid="C", status=None)]
    silver = accepted_sales(tables(spark, rows))
    got = {r["transaction_id"]: (r["realized_revenue"], r["realized_margin"]) for r in silver.collect()}
    assert got["A"] == (48.2, 16.45)
    assert got["B"] == (Decimal("0.00"), Decimal("0.00"))
    assert got["C"] == (Decimal("0.00"), Decimal("0.00"))


def test_average_order_value_zero_without_order_ids(spark):
    # All order ids NULL on a day -> 0.
    rows = [sale(tid="A", oid=None), sale(tid="B", oid=None)]
    row = metric_overview_daily(accepted_sales(tables(spark, rows))).collect()[0]
    assert row["order_count"] == 0 and row["order_line_count"] == 2
    assert row["average_order_value"] == 0.0 and row["net_revenue"] == 96.4


def test_average_order_value_rounds_half_up_in_cents(spark):
    # 100.01 / 2 = 50.005 -> 50.01 (half-up), exactly.
    rows = [sale(tid="A", oid="O1", net="100.01"), sale(tid="B", oid="O2", net="0.00")]
    row = metric_overview_daily(accepted_sales(tables(spark, rows))).collect()[0]
    assert row["average_order_value"] == 50.01


def test_passes_is_the_two_valued_complement_of_fires(spark):
    """For every rule: passes == NOT coalesce(fires, false), NULL and NaN included."""
    schema = StructType([
        StructField("_duplicate_rank", IntegerType()),
        StructField("product_id", StringType()), StructField("product_name", StringType()),
        StructField("city", StringType()), StructField("year", IntegerType()),
        StructField("quantity", IntegerType()), StructField("unit_price", DoubleType()),
        StructField("unit_cost", DoubleType()), StructField("channel", StringType()),
        StructField("order_status", StringType()), StructField("net_revenue", DoubleType()),
    ])
    nums = [None, -1.0, -0.0, 0.0, 0.5, math.nan]
    values = {
        "_duplicate_rank": [1, 2], "product_id": [None, "", "P1"], "product_name": [None, "x"],
        "city": [None, "x"], "year": [None, 2025], "quantity": [None, -1, 0, 1],
        "unit_price": nums, "unit_cost": nums, "channel": [None, "store", "fax", "Store"],
        "order_status": [None, "paid", "cancelled", "refunded"], "net_revenue": nums,
    }
    names = [f.name for f in schema.fields]
    rows = []
    for i, name in enumerate(names):  # vary one column at a time around a valid row
        base = [1, "P1", "x", "x", 2025, 1, 1.0, 1.0, "store", "paid", 1.0]
        for v in values[name]:
            row = list(base)
            row[i] = v
            rows.append(tuple(row))
    df = spark.createDataFrame(rows, schema)
    checks = [
        (~F.coalesce(rule.fires(), F.lit(False)) == rule.passes()).alias(rule.reason) for rule in RULES
    ]
    result = df.select(*checks).collect()
    for r in result:
        assert all(r[rule.reason] for rule in RULES), r
    assert set(RULES_BY_REASON) == {rule.reason for rule in RULES}
    assert len(list(itertools.chain(rows))) == len(result)


def test_double_money_frames_with_nan_run_through(spark):
    # Frames with DOUBLE money (the source's in-memory test style); NaN passes the rules.
    from pyspark.sql.types import DoubleType, StructField, StructType

    from salesmart.schemas import SALES_SCHEMA, as_read

    double_schema = StructType([
        StructField(f.name, DoubleType(), True) if "decimal" in f.dataType.simpleString() else f
        for f in as_read(SALES_SCHEMA).fields
    ])
    rows = [tuple(float(v) if isinstance(v, Decimal) else v for v in sale(tid="A", net=None)),
            tuple(float(v) if isinstance(v, Decimal) else v for v in sale(tid="B", oid="O2"))]
    rows[0] = rows[0][:10] + (math.nan,) + rows[0][11:]
    t = tables(spark, [])
    t["sales_transactions"] = spark.createDataFrame(rows, double_schema)
    silver = accepted_sales(t)
    assert silver.count() == 2
    row = metric_overview_daily(silver).collect()[0]
    assert math.isnan(row["net_revenue"]) and math.isnan(row["average_order_value"])
    assert row["order_line_count"] == 2 and row["gross_revenue"] == 96.4


def test_ids_and_dimension_keys_are_not_normalised(spark):
    # Padded transaction ids are different ids; a padded dimension key does not match;
    # identity is the transaction id alone (different content, same id -> duplicate).
    products = [(" P001", "Kettle", "kitchen", "B", Decimal("1.00"), Decimal("1.00"), dt.date(2024, 1, 1), True),
                ("P002", "Lamp", "kitchen", "B", Decimal("1.00"), Decimal("1.00"), dt.date(2024, 1, 1), True)]
    rows = [sale(tid="T1", product="P002"), sale(tid=" T1", product="P002"),
            sale(tid="T2", product="P001"), sale(tid="T3", product="P002", qty=2),
            sale(tid="T3", product="P002", qty=3)]
    checked = checked_sales(tables(spark, rows, product_rows=products)).orderBy("_source_row_id").collect()
    assert [(r["transaction_id"], r[QUALITY_REASON]) for r in checked] == [
        ("T1", ""), (" T1", ""), ("T2", "unknown_product"), ("T3", ""), ("T3", "duplicate_transaction")]
