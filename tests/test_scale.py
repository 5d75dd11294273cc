"""How far the lines are moved: ranks on narrow lines, few stores broadcast, files by size."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.operators.dedup import DUPLICATE_RANK, SkewPolicy, rank_duplicates, rank_split
from salesmart.operators.normalize import add_source_row_id
from salesmart.plans import catalog, job
from salesmart.schemas import SCHEMAS
from salesmart.session import checkpoint_root, scratch_uri
from salesmart.sources import fixtures
from salesmart.sources import retailview as rv
from salesmart.sources.files import ORIGIN_COLUMNS, _file_system, read_csv
from salesmart.sources.fixtures import build_raw_dataset
from salesmart.sources.layout import Layout

ORDER = ["_source_row_id"]


@pytest.fixture(scope="module")
def sf_dir(spark):
    """Small driver tables: 300 lines of 60 orders, every tenth line a later copy; one order and one part come twice."""
    root = scratch_uri(spark, "scale-tables")
    day = dt.datetime(1995, 1, 1)
    lines = [
        (i // 5 + 1, i % 40 + 1, i % 6 + 1, i % 5 + 1, 3.0, 100.0 + i, 0.05, day + dt.timedelta(days=i))
        for i in range(300)
    ]
    lines += [(o, p + 1, s, n, *rest) for o, p, s, n, *rest in lines[::10]]
    orders = [(i + 1, "FPO"[i % 3], day + dt.timedelta(days=3 * i), f"{i % 5 + 1}-X") for i in range(60)]
    parts = [(i + 1, f"part {i % 7}", "Brand#1", f"TYPE {i % 3}", 50.0 + i) for i in range(41)]
    rows = {
        "lineitem": lines,
        "orders": [*orders, orders[6]],
        "part": [*parts, (9, "part 1", "Brand#1", "TYPE 2", 58.0)],
        "supplier": [(i + 1, i % 2) for i in range(6)],
        "nation": [(0, "KENYA", 0), (1, "PERU", 1)],
        "region": [(0, "AFRICA"), (1, "AMERICA")],
    }
    for name, values in rows.items():
        frame = spark.createDataFrame(values, rv.DRIVER_SCHEMAS[name])
        frame.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def no_broadcast(spark):
    """As with large tables: Spark broadcasts nothing by itself."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x.strip() for x in plan.splitlines() if "Exchange hashpartitioning" in x]


# -- F3, F4


def test_split_rank_equals_plain_window(spark):
    rows = [("HOT", i * 7 % 401) for i in range(400)] + [(None, 1000 + i) for i in range(300)]
    rows += [(f"K{i}", 5000 + i * 3 + c) for i in range(200) for c in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "transaction_id string, _source_row_id long").repartition(7)
    split = rank_split(df)
    assert _same(rank_duplicates(df), split)
    # the window has the light keys alone
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "_heavy" in plan and plan.count("Union") == 1


def test_split_rank_refuses_an_order_that_does_not_tell_lines_apart(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), *[(f"B{i}", i) for i in range(400)]], "transaction_id string, _source_row_id long")
    with pytest.raises(PySparkException, match="does not order"):
        rank_split(df).select("transaction_id").collect()


@pytest.mark.parametrize("name", ["enriched_sales", "quarantine_sales"])
def test_the_contract_columns_move_for_the_products_alone(spark, sf_dir, no_broadcast, name):
    df = catalog.catalog()[name](spark, sf_dir)
    moved = _exchanges(df)
    assert not [x for x in moved if "store_id" in x]
    assert len([x for x in moved if "hashpartitioning(product_id" in x]) == 2  # the lines and the products


def test_lines_ranked_before_the_joins_equal_lines_ranked_by_their_keys(spark, sf_dir):
    from salesmart.plans.silver import enriched_sales

    was = enriched_sales(rv.raw_tables(spark, sf_dir), rv.SOURCE_ORDER, keys=rv.sales_keys(spark, sf_dir))
    now = catalog.enriched_sales_q(spark, sf_dir)
    assert _same(catalog.public(was), now)
    assert now.where(F.col(DUPLICATE_RANK) > 1).count() > 0


# -- F5, F6, F7


def test_silver_takes_one_line_of_a_transaction_whatever_its_order_and_part_have(spark, sf_dir):
    from salesmart.plans.silver import accepted_sales

    was = catalog.public(accepted_sales(rv.raw_tables(spark, sf_dir), rv.SOURCE_ORDER))
    now = catalog.silver_sales(spark, sf_dir)
    assert now.count() > 100 and _same(was, now)


def test_silver_ranks_narrow_lines_with_a_group_limit(spark, sf_dir, no_broadcast):
    df = catalog.silver_sales(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    by_id = plan.split("Exchange hashpartitioning(transaction_id", 1)[1]
    assert "Join" not in by_id.split("FileScan", 1)[0] and "l_linenumber" in by_id.split("FileScan", 1)[1]
    assert not [x for x in _exchanges(df) if "store_id" in x]


def test_stored_silver_is_dealt_out_before_stores_and_calendar(spark, sf_dir):
    stored = catalog._stored_silver(spark, sf_dir)
    silver = catalog._silver(spark, sf_dir)
    as_text = [F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in silver.dtypes]
    assert _same(silver.select(*as_text), catalog.public(stored))
    dealt = catalog.accepted_sales(catalog._first_copies(spark, sf_dir), rv.SOURCE_ORDER, by_month=True)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [_month_start" in plan
    below = plan.split("RebalancePartitions", 1)[1]
    assert "population_segment" not in below and "month_name" not in below.split("Join", 1)[0]
    files = stored.inputFiles()
    months = {tuple(p for p in f.split("/") if p.startswith(("year=", "month="))) for f in files}
    assert len(files) == len(months)  # one file a month, as the lines are few


def test_many_stores_are_left_to_sparks_threshold(spark, sf_dir, monkeypatch):
    from salesmart.operators import enrich

    assert enrich.few_stores(rv.stores(spark, sf_dir))
    monkeypatch.setattr(enrich, "BROADCAST_STORES", 5)
    assert not enrich.few_stores(rv.stores(spark, sf_dir))
    assert catalog._stored_silver(spark, sf_dir).count() == catalog._silver(spark, sf_dir).count()


def test_parquet_layers_are_zstd(spark):
    from salesmart.sources.files import write_parquet

    path = scratch_uri(spark, "zstd")
    write_parquet(spark.range(5).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert all(".zstd.parquet" in f for f in spark.read.parquet(path).inputFiles())


# -- F2


def test_raw_csv_files_grow_with_the_lines(spark, sf_dir, monkeypatch):
    written = []
    write = catalog.files.write_csv
    monkeypatch.setattr(catalog, "LINES_PER_FILE", 20)
    monkeypatch.setattr(catalog.files, "write_csv", lambda df, path: (written.append(path), write(df, path)))
    ranked = catalog.csv_file_order_rank(spark, sf_dir)
    assert len(spark.read.text(written[0]).inputFiles()) > 10  # 330 lines and more: 17 files
    expected = rank_duplicates(rv.raw_sales(spark, sf_dir), order_by=rv.SOURCE_ORDER)
    ids = lambda df: df.groupBy("transaction_id", DUPLICATE_RANK).count()
    assert _same(ids(expected), ids(ranked))


# -- F1 (job_outputs)


def _job_layout(spark):
    base = scratch_uri(spark, "scale-job")
    return Layout(f"{base}/raw", f"{base}/warehouse")


def test_job_moves_stored_lines_for_the_months_alone(spark, sf_dir, no_broadcast, monkeypatch):
    layout, plans = _job_layout(spark), []
    write = job.write_lines

    def noted(enriched, layout, by_month=None):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (enriched, by_month))
        write(enriched, layout, by_month)

    monkeypatch.setattr(job, "write_lines", noted)
    build_raw_dataset(spark, sf_dir, layout, inject_defects=False)
    job.run(spark, layout)
    checked, by_month = plans
    assert not [x for x in checked.splitlines() if "Exchange" in x and "Broadcast" not in x]
    moved = [x for x in by_month.splitlines() if "Exchange" in x and "Broadcast" not in x]
    assert len(moved) == 1 and "_month_start" in moved[0]
    # the stored lines go with the run
    files, root = _file_system(spark, f"{checkpoint_root(spark)}/salesmart")
    assert not [s.getPath().getName() for s in files.listStatus(root) if s.getPath().getName().startswith("lines-with")]


def test_lines_to_store_move_once_for_ranks_and_once_for_products(spark, sf_dir, no_broadcast):
    from salesmart.plans.silver import sales_with_products

    sales = rv.raw_sales(spark, sf_dir, one_each=True)
    moved = _exchanges(sales_with_products(rv.raw_tables(spark, sf_dir, sales), rv.SOURCE_ORDER))
    assert len([x for x in moved if "hashpartitioning(product_id" in x]) == 2  # the lines and the products
    assert len([x for x in moved if re.search(r"hashpartitioning\(transaction_id#\d+, ", x)]) == 1


@pytest.mark.parametrize("skew", [SkewPolicy(), None])
def test_job_writes_the_lines_of_the_checked_plan(spark, sf_dir, skew):
    from salesmart.operators.quality import accepted_only, add_quality_reason, rejected_only
    from salesmart.plans.bronze import read_bronze, without_ingest_time
    from salesmart.plans.silver import enriched_sales, read_silver, to_silver

    layout = _job_layout(spark)
    build_raw_dataset(spark, sf_dir, layout, inject_defects=False)
    job.run(spark, layout, skew=skew)
    bronze = read_bronze(spark, {n: f"{layout.bronze_dir}/{n}" for n in SCHEMAS})
    enriched = enriched_sales({n: without_ingest_time(t) for n, t in bronze.items()})
    quarantine = spark.read.parquet(layout.quarantine_sales_path)
    assert quarantine.where(F.col(DUPLICATE_RANK) > 1).count() > 0
    assert _same(rejected_only(add_quality_reason(enriched)), quarantine)
    silver = read_silver(spark, layout.silver_sales_path)
    assert silver.count() > 100 and _same(to_silver(accepted_only(enriched)).select(*silver.columns), silver)


def test_raw_lines_are_put_in_order_on_their_narrow_columns(spark, sf_dir, no_broadcast, monkeypatch):
    layout, plans = _job_layout(spark), []
    write = fixtures.write_csv

    def noted(df, path, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, **options)

    monkeypatch.setattr(fixtures, "write_csv", noted)
    build_raw_dataset(spark, sf_dir, layout, inject_defects=False, sales_files=5)
    below = plans[0].split("Exchange rangepartitioning", 1)[1]
    assert "l_orderkey" in below and "AS order_status" not in below and "AS margin" not in below
    lines = read_csv(spark, layout.sales_path, SCHEMAS["sales_transactions"], origin=True)
    files = lines.inputFiles()
    assert len(files) > 1 and all(f.endswith(".csv.gz") for f in files)
    raw = rv.raw_sales(spark, sf_dir).drop(*rv.SOURCE_ORDER)
    money = [F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in raw.dtypes]
    assert _same(raw.select(*money), lines.drop(*ORIGIN_COLUMNS))
    # place in the files is the source order, so first copies stay first
    ranked = rank_duplicates(add_source_row_id(lines), order_by=[*ORIGIN_COLUMNS, "_source_row_id"])
    expected = rank_duplicates(rv.raw_sales(spark, sf_dir), order_by=rv.SOURCE_ORDER)
    first = lambda df: df.where(F.col(DUPLICATE_RANK) == 1).select("transaction_id", "product_id", "store_id")
    assert _same(first(expected), first(ranked))
