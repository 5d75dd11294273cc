"""Line measures, defect injection, dataset checks, report counts and patterns."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import checks, patterns, report
from salesmart.operators.defects import inject_quality_issues
from salesmart.operators.normalize import line_measures
from salesmart.plans.silver import accepted_sales, checked_sales
from tests.fixtures import clean_lines, sale, tables


def test_line_measures_round_each_step_and_zero_cancelled(spark):
    df = spark.createDataFrame(
        [(3, Decimal("19.99"), Decimal("15.00"), Decimal("12.345"), "paid"),
         (2, Decimal("10.00"), Decimal("5.00"), Decimal("7.00"), " Cancelled ")],
        "q int, price decimal(18,3), disc decimal(18,2), cost decimal(18,3), status string",
    )
    out = df.select(*line_measures(F.col("q"), F.col("price"), F.col("disc"), F.col("cost"), F.col("status")))
    paid, cancelled = out.collect()
    # gross 59.97; net round(59.97 * 0.85) = 50.97 (50.9745); cost 3 * 12.35 = 37.05; margin 13.92
    assert (paid["gross_revenue"], paid["net_revenue"], paid["total_cost"], paid["margin"]) == (
        Decimal("59.97"), Decimal("50.97"), Decimal("37.05"), Decimal("13.92"))
    assert (cancelled["gross_revenue"], cancelled["net_revenue"], cancelled["total_cost"], cancelled["margin"]) == (
        Decimal("20.00"), Decimal("0.00"), Decimal("14.00"), Decimal("0.00"))


def test_injected_lines(spark):
    t = tables(spark, clean_lines(5))
    start = spark.range(1).select(F.lit("2025-01-01").cast("date").alias("start"))
    out = inject_quality_issues(t["sales_transactions"], ["transaction_id"], start)
    assert out.count() == 8
    rows = {r["transaction_id"]: r for r in out.where(F.col("transaction_id").startswith("T_")).collect()}
    bad = rows["T_INVALID_PRICE"]
    assert bad["order_id"] == "O_INVALID_PRICE" and bad["transaction_date"] == dt.date(2025, 1, 11)
    assert (bad["unit_price"], bad["gross_revenue"], bad["net_revenue"], bad["margin"]) == (
        Decimal("-99.00"), Decimal("-99.00"), Decimal("-99.00"), Decimal("-150.00"))
    assert bad["order_status"] == "paid"
    missing = rows["T_MISSING_PRODUCT"]
    assert missing["product_id"] == "UNKNOWN_PRODUCT" and missing["transaction_date"] == dt.date(2025, 1, 21)
    assert out.where(F.col("transaction_id") == "T00000001").count() == 2  # the exact copy


def test_order_checks(spark):
    rows = [sale(tid="A", oid="O1"), sale(tid="B", oid="O1", store="S002"),
            sale(tid="C", oid="O2"), sale(tid="D", oid="O3"), sale(tid="E", oid="O3", channel=None)]
    sales = tables(spark, rows)["sales_transactions"]
    conflicts = checks.order_metadata_conflicts(sales).collect()
    assert [(r["order_id"], r["store_id_differs"], r["channel_differs"]) for r in sorted(conflicts)] == [
        ("O1", True, False), ("O3", False, True)]  # NULL against a value differs
    hist = {r["lines_per_order"]: r["order_count"] for r in checks.order_line_histogram(sales).collect()}
    assert hist == {2: 2, 1: 1}


def test_dataset_differences_count_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    got = sorted((r["side"], r["x"]) for r in checks.dataset_differences(a, b).collect())
    assert got == [("left_only", 1), ("right_only", 3)]
    assert checks.dataset_differences(a, a).count() == 0


def test_report_counts_by_substring_and_combination(spark):
    # One line counts for several kinds; the reason map is per combination.
    rows = [sale(tid="A"), sale(tid="A", price="0.00"), sale(tid="B", product="P999", price="-1.00"),
            sale(tid="C", product=None)]
    t = tables(spark, rows)
    checked = checked_sales(t)
    counts = report.report_counts(report.count_rows(t["sales_transactions"]), checked).first().asDict()
    assert counts == {"input_rows": 4, "accepted_rows": 1, "rejected_rows": 3, "duplicate_rows": 1,
                      "missing_product_rows": 2, "invalid_price_rows": 2}
    reasons = {r["quality_reason"]: r["row_count"] for r in report.rejection_reasons(
        checked.where(F.col("quality_reason") != "")).collect()}
    assert reasons == {"duplicate_transaction|invalid_unit_price": 1,
                       "unknown_product|invalid_unit_price": 1,
                       "missing_product_id|unknown_product": 1}
    acct = report.row_accounting(report.count_rows(t["sales_transactions"]), checked).first()
    assert acct["balanced"]


def test_pattern_shares_sum_to_one(spark):
    silver = accepted_sales(tables(spark, clean_lines(30), start="2025-01-01", end="2025-12-31"))
    for frame, df in [
        (["year", "month"], patterns.channel_share_monthly(silver)),
        (["year", "month"], patterns.category_share_monthly(silver)),
        (["is_weekend"], patterns.weekend_effect(silver)),
        (["in_event_window"], patterns.category_share_event_window(silver)),
    ]:
        for r in df.groupBy(*frame).agg(F.sum("share").alias("s")).collect():
            assert abs(r["s"] - 1.0) < 1e-9


def test_injection_needs_three_lines(spark):
    import pytest

    from salesmart.operators.defects import NotEnoughRows, require_rows

    sales = tables(spark, clean_lines(2))["sales_transactions"]
    with pytest.raises(NotEnoughRows):
        require_rows(sales, 3)
    require_rows(tables(spark, clean_lines(3))["sales_transactions"], 3)


def test_order_metadata_null_against_value_is_a_conflict(spark):
    from salesmart.operators.checks import order_metadata_conflicts
    from tests.fixtures import sale, tables

    rows = [sale(tid="a", oid="X"), sale(tid="b", oid="X", channel=None), sale(tid="c", oid="Y", channel=None),
            sale(tid="d", oid="Y", channel=None), sale(tid="e", oid="Z", store="S002"), sale(tid="f", oid="Z")]
    got = {r["order_id"]: r for r in order_metadata_conflicts(tables(spark, rows)["sales_transactions"]).collect()}
    assert set(got) == {"X", "Z"}
    assert got["X"]["channel_differs"] and not got["X"]["store_id_differs"] and got["Z"]["store_id_differs"]


def test_dataset_differences_count_copies_and_shuffle_rows_once(spark):
    from salesmart.operators.checks import dataset_differences

    left = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    diff = dataset_differences(left, right)
    # whole rows are shuffled once, and only those of differing buckets; fingerprints by bucket
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(a#") == 1
    assert plan.count("FullOuter") == 1 and plan.count("BroadcastHashJoin") == 1
    got = sorted((r["side"], r["a"], r["b"]) for r in diff.collect())
    assert got == [("left_only", 1, None), ("left_only", 2, "x"), ("left_only", 2, "x"), ("right_only", 3, "y")]


def test_double_sums_are_exact_and_keep_nan(spark):
    from salesmart.functions.money import rounded_mean, rounded_sum

    rows = [("a", 0.1)] * 10 + [("b", 1e16), ("b", 0.01), ("c", float("nan")), ("c", 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: (r["s"], r["m"]) for r in df.groupBy("k").agg(
        rounded_sum(df, "x").alias("s"), rounded_mean(df, "x", F.count("*")).alias("m")).collect()}
    assert got["a"] == (1.0, 0.1) and got["b"][0] == 1e16 + 0.01
    assert got["c"][0] != got["c"][0] and got["c"][1] != got["c"][1] and got["d"] == (None, None)
