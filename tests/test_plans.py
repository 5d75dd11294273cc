"""Plan-shape tests: what Catalyst makes of the silver-only path."""

from __future__ import annotations

from salesmart.plans.gold import metric_overview_daily
from salesmart.plans.silver import accepted_sales, silver_from_checked, checked_sales
from tests.fixtures import clean_lines, tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_only_path_has_inner_joins_and_group_limit(spark):
    plan = _plan(accepted_sales(tables(spark, clean_lines(10))))
    assert "WindowGroupLimit" in plan  # top-1 per transaction before and after the shuffle
    assert "LeftOuter" not in plan  # accept filter turned the dimension joins into inner joins


def test_reason_string_path_keeps_outer_joins(spark):
    # The checked path needs the rejects, so the joins stay outer.
    plan = _plan(silver_from_checked(checked_sales(tables(spark, clean_lines(10)))))
    assert "LeftOuter" in plan


def test_both_paths_accept_the_same_rows(spark):
    t = tables(spark, clean_lines(30))
    a = accepted_sales(t)
    b = silver_from_checked(checked_sales(t))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gold_is_partial_plus_final_aggregate(spark):
    plan = _plan(metric_overview_daily(accepted_sales(tables(spark, clean_lines(10)))))
    assert plan.count("HashAggregate") >= 2
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_gold_sql_path_equals_dataframe_path(spark):
    from salesmart.plans.gold import build_gold_tables
    from salesmart.plans.gold_sql import build_gold_tables_sql

    silver = accepted_sales(tables(spark, clean_lines(30)))
    by_df = build_gold_tables(silver)
    by_sql = build_gold_tables_sql(spark, silver)
    assert by_df.keys() == by_sql.keys()
    for name in by_df:
        a, b = by_df[name], by_sql[name]
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_gold_reads_the_silver_lines_twice(spark):
    """Base partials and (day, order) pairs; the five tables read these two alone."""
    from salesmart.plans.job import write_lines
    from salesmart.plans.lattice import base_partials, order_partials, gold_from, read_partials, write_partials
    from salesmart.plans.silver import enriched_sales, read_silver
    from salesmart.session import scratch_uri
    from salesmart.sources.layout import Layout

    base = scratch_uri(spark, "lattice-plan")
    layout = Layout(f"{base}/raw", f"{base}/wh")
    write_lines(enriched_sales(tables(spark, clean_lines(10))), layout)
    silver = read_silver(spark, layout.silver_sales_path)
    for df in (base_partials(silver), order_partials(silver)):
        plan = _plan(df)
        assert plan.count("FileScan") == 1 and "Window" not in plan and "Join" not in plan
    write_partials(silver, layout.partials_dir, "run")
    partials = read_partials(spark, layout.partials_dir)
    for name, df in gold_from(*partials).items():
        plan = _plan(df)
        assert "sales_enriched" not in plan and plan.count("FileScan") <= 2, name


def test_silver_reads_one_month_by_its_directories(spark):
    from salesmart.plans.silver import read_silver, write_silver
    from salesmart.session import scratch_uri

    path = scratch_uri(spark, "silver-months")
    silver = accepted_sales(tables(spark, clean_lines(30), start="2025-01-01", end="2025-03-31"))
    write_silver(silver, path)
    back = read_silver(spark, path)
    assert back.columns == silver.columns and [f.dataType for f in back.schema] == [f.dataType for f in silver.schema]
    assert back.exceptAll(silver).count() == 0 and silver.exceptAll(back).count() == 0
    month = back.where("year = 2025 and month = 1").select("order_id")
    filters = _plan(month).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "year" in filters and "month" in filters
