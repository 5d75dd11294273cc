"""Exact sums of DOUBLE, mergeable gold partials, late batches, SQL over DOUBLE silver."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions import money
from salesmart.operators.checks import dataset_differences
from salesmart.plans import gold, gold_sql, lattice
from salesmart.plans.job import run
from salesmart.plans.silver import accepted_sales, read_silver
from salesmart.session import scratch_uri
from salesmart.sources.fixtures import write_raw_dataset
from salesmart.sources.layout import Layout
from tests.fixtures import clean_lines, sale, tables

amounts = st.one_of(
    st.floats(min_value=-1e25, max_value=1e25).map(lambda x: x if abs(x) > 1e-12 else 0.0),
    st.sampled_from([0.1, -0.1, 1e-12, -1e-12, 1e25, -1e25, 0.005, 1.005, 1e17, 123456789.01, 0.0, -0.0]),
)


def nearest(column):
    return F.expr(money._let("limbs", money._limb_sums(column), money.nearest_double("limbs")))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(amounts, min_size=1, max_size=12), min_size=1, max_size=25), st.randoms(use_true_random=False))
def test_sums_are_the_nearest_double_in_any_order(spark, groups, rnd):
    rows = [(g, x) for g, xs in enumerate(groups) for x in xs]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(3)
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(nearest("x").alias("s")).collect()}
    assert got == {g: math.fsum(xs) for g, xs in enumerate(groups)}


def test_sums_of_tiny_huge_and_cancelling_amounts(spark):
    cases = {
        "tiny": ([1e-12] * 1000, 0.0),
        "huge": ([1e25, 1.005, -1e25], 1.01),
        "cents": ([0.1] * 10, 1.0),
        "sub": ([0.005, 0.01], 0.02),
        "minus": ([-0.005], -0.01),
        "wide": ([1e35, 3.14, -1e35], 3.14),
        "nothing": ([None, None], None),
        "zero": ([-0.0, 0.0], 0.0),
        "infinite": ([math.inf, 1.0], math.inf),
        "beyond": ([1e300, 1.0], 1e300),
    }
    rows = [(k, x) for k, (xs, _) in cases.items() for x in xs]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(money.rounded_sum(df, "x").alias("s")).collect()}
    assert got == {k: e for k, (_, e) in cases.items()}
    nan = spark.createDataFrame([(math.nan,), (1.0,)], "x double")
    assert math.isnan(nan.agg(money.rounded_sum(nan, "x")).first()[0])


def test_states_of_parts_merge_to_the_state_of_all(spark):
    rnd = random.Random(4)
    rows = [(i % 3, rnd.choice([1, -1]) * rnd.random() * 10 ** rnd.randint(-12, 25)) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, x double")
    part = F.pmod(F.xxhash64("x"), F.lit(4))
    states = df.groupBy("g", part.alias("p")).agg(*money.money_state(df, "x"))
    merged = states.groupBy("g").agg(*money.state_merge(states, "x"))
    got = {r["g"]: r["s"] for r in merged.select("g", F.expr(money.nearest_double("x_total")).alias("s")).collect()}
    assert got == {g: math.fsum(x for k, x in rows if k == g) for g in range(3)}


def odd_silver(spark):
    """Silver with DOUBLE money: NaN, 1e17 and sub-cent amounts, a day of cancelled lines, no order id."""
    odd = [
        sale(tid="A1", oid="A", net="0.004", margin="0.001"),
        sale(tid="A2", oid="A", net="0.002", day=dt.date(2025, 1, 2)),
        sale(tid="B1", oid="B", net="1e17", gross="1e17", day=dt.date(2025, 1, 3)),
        sale(tid="B2", oid="B", net="0.01", product="P002", day=dt.date(2025, 1, 3)),
        sale(tid="C1", oid="C", net="NaN", day=dt.date(2025, 1, 4)),
        sale(tid="C2", oid="D", net="5.00", store="S002", day=dt.date(2025, 1, 4)),
        sale(tid="D1", oid=None, net="7.00", day=dt.date(2025, 1, 5)),
        sale(tid="E1", oid="E", net="3.00", status="cancelled", day=dt.date(2025, 1, 6)),
        sale(tid="F1", oid="F", net="10.01", day=dt.date(2025, 1, 7)),
        sale(tid="F2", oid="G", net="0.00", day=dt.date(2025, 1, 7)),
    ]
    return accepted_sales(tables(spark, [*odd, *clean_lines(30)]))


def same(a, b):
    def rows(df):
        return sorted(str([None if v is None else v for v in r]) for r in df.collect())

    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert rows(a) == rows(b)


@pytest.mark.parametrize("exact", [False, True])
def test_gold_by_sql_and_from_partials_equals_gold_by_dataframe(spark, exact):
    if exact:
        silver = accepted_sales(tables(spark, clean_lines(30)))
        silver = silver.withColumns({c: F.col(c).cast("decimal(18,2)") for c, t in silver.dtypes if t == "double"})
    else:
        silver = odd_silver(spark)
    from_partials = lattice.gold_from(lattice.base_partials(silver), lattice.order_partials(silver))
    for name, table in gold.build_gold_tables(silver).items():
        same(gold_sql.gold_table_sql(spark, silver, name), table)
        same(from_partials[name], table)


def test_sql_path_leaves_the_callers_view_alone(spark):
    spark.range(1).createOrReplaceTempView(gold_sql.SILVER_VIEW)
    first = gold_sql.gold_table_sql(spark, odd_silver(spark), gold.OVERVIEW)
    other = gold_sql.gold_table_sql(spark, odd_silver(spark).limit(0), gold.OVERVIEW)
    assert first.count() > 0 and other.count() == 0
    assert spark.table(gold_sql.SILVER_VIEW).columns == ["id"]


def test_partials_of_batches_merge(spark):
    silver = odd_silver(spark)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    parts = [silver.where(~late), silver.where(late)]
    base = lattice.merge_base([lattice.base_partials(p) for p in parts])
    orders = lattice.merge_orders([lattice.order_partials(p) for p in parts])
    plain = [c for c in base.columns if c.endswith("_plain")]  # the plain sums alone depend on the order
    same(base.drop(*plain), lattice.base_partials(silver).drop(*plain))
    plain = [c for c in orders.columns if c.endswith("_plain")]
    same(orders.drop(*plain), lattice.order_partials(silver).drop(*plain))


def test_a_late_batch_adds_to_the_gold_tables(spark):
    base = scratch_uri(spark, "late")
    lines = clean_lines(40)
    for name, part in (("all", lines), ("early", lines[:27]), ("late", lines[27:])):
        layout = Layout(f"{base}/{name}/raw", f"{base}/{name}/wh")
        write_raw_dataset(spark, tables(spark, part), layout, order_by=[], sales_files=1)
        run(spark, layout)
    early = Layout(f"{base}/early/raw", f"{base}/early/wh")
    late = read_silver(spark, Layout("", f"{base}/late/wh").silver_sales_path)
    for _ in range(2):  # a repeated call changes nothing
        lattice.add_late_lines(spark, early, late, "late")
        for name in gold.GOLD_TABLES:
            got = spark.read.parquet(early.gold_path(name))
            whole = spark.read.parquet(Layout("", f"{base}/all/wh").gold_path(name))
            assert dataset_differences(got, whole).count() == 0, name
