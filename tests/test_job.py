"""End-to-end job on raw CSVs (the source's pipeline test, rebuilt) and CSV semantics."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from salesmart.operators.defects import inject_quality_issues
from salesmart.plans.gold import GOLD_TABLES
from salesmart.plans.job import read_report, run
from salesmart.plans.silver import read_silver
from salesmart.schemas import SALES_SCHEMA, SchemaContractError
from salesmart.session import scratch_uri
from salesmart.sources.files import read_csv, write_csv
from salesmart.sources.fixtures import write_manifest, write_raw_dataset
from salesmart.sources.layout import Layout
from tests.fixtures import clean_lines, tables



def test_job_quarantines_the_injected_lines(spark):
    base = scratch_uri(spark, "job-test")
    layout = Layout(f"{base}/raw", f"{base}/warehouse")
    t = tables(spark, clean_lines(30), start="2025-01-01", end="2025-03-31")
    start = spark.range(1).select(F.lit("2025-01-01").cast("date").alias("start"))
    t["sales_transactions"] = inject_quality_issues(t["sales_transactions"], ["transaction_id"], start)
    counts = write_raw_dataset(spark, t, layout, order_by=[], sales_files=2)
    manifest = write_manifest(spark, layout, counts, injected=True)
    assert manifest["counts"]["sales_transactions"] == 33
    assert manifest["injected_quality_issues"] == ["duplicate_transaction", "invalid_price", "unknown_product"]

    report = run(spark, layout)
    assert report["input_rows"] == 33
    assert report["accepted_rows"] == 30
    assert report["rejected_rows"] == 3
    assert report["duplicate_rows"] == 1
    assert report["missing_product_rows"] == 1
    assert report["invalid_price_rows"] == 1
    assert report["rejection_reasons"] == {
        "duplicate_transaction": 1,
        "invalid_unit_price|invalid_net_revenue": 1,
        "unknown_product": 1,
    }
    assert report["timezone"] == "Europe/Warsaw" and report["run_id"]
    assert read_report(spark, layout.quality_report_path)["accepted_rows"] == 30
    for path, field in ((layout.quality_report_path, "rejection_reasons"), (layout.manifest_path, "counts")):
        with open(path.removeprefix("file:")) as f:
            assert json.load(f)[field]
    money = dict(spark.read.parquet(layout.silver_sales_path).dtypes)
    assert money["net_revenue"] == money["unit_price"] == money["realized_margin"] == "double"

    assert spark.read.parquet(f"{layout.bronze_dir}/sales_transactions").count() == 33
    stored = spark.read.parquet(layout.silver_sales_path)
    assert stored.columns[-2:] == ["year", "month"]  # its directory levels
    silver = read_silver(spark, layout.silver_sales_path)
    assert set(silver.columns) == set(stored.columns) and stored.count() == 30
    quarantine = spark.read.parquet(layout.quarantine_sales_path)
    assert silver.count() == 30 and quarantine.count() == 3
    assert silver.columns[:2] == ["store_id", "product_id"]
    assert silver.columns[-2:] == ["realized_revenue", "realized_margin"]
    assert not [c for c in silver.columns if c.startswith("_")] and "quality_reason" not in silver.columns
    assert quarantine.columns[-1] == "quality_reason" and "_duplicate_rank" in quarantine.columns
    assert len(silver.columns) == 38 and len(quarantine.columns) == 39
    for name in GOLD_TABLES:
        assert spark.read.parquet(layout.gold_path(name)).count() > 0
    overview = spark.read.parquet(layout.gold_path("metric_overview_daily"))
    # Gold holds paid lines only: 30 clean lines minus the cancelled orders' lines.
    paid = sum(1 for r in clean_lines(30) if r[-1] == "paid")
    assert overview.agg(F.sum("order_line_count")).first()[0] == paid


def test_csv_reordered_header_is_refused(spark):
    # S3: Spark binds a schema by position; the header check runs first.
    path = scratch_uri(spark, "reordered")
    df = tables(spark, clean_lines(3))["sales_transactions"]
    cols = df.columns
    write_csv(df.select(cols[1], cols[0], *cols[2:]), path)
    with pytest.raises(SchemaContractError):
        read_csv(spark, path, SALES_SCHEMA)


def test_csv_unparsable_values_become_null_and_hit_rules(spark):
    # PERMISSIVE read, empty fields are NULL.
    path = scratch_uri(spark, "dirty-csv")
    header = ",".join(SALES_SCHEMA.fieldNames())
    lines = [
        header,
        "T1,O1,2025-01-01,P001,S001,store,x,48.20,0,48.20,48.20,31.75,31.75,16.45,paid",
        "T2,O2,2025-13-40,P001,S001,store,1,48.20,0,48.20,48.20,31.75,31.75,16.45,paid",
        'T3,O3,2025-01-01,"",S001,store,1,yes,0,48.20,48.20,31.75,31.75,16.45,paid',
        "T4,O4,2025-01-01,,S001,store,3.5,48.20,0,48.20,48.20,31.75,31.75,16.45,paid",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    df = read_csv(spark, path, SALES_SCHEMA)
    got = {r["transaction_id"]: r for r in df.collect()}
    assert got["T1"]["quantity"] is None
    assert got["T2"]["transaction_date"] is None
    assert got["T3"]["product_id"] is None and got["T3"]["unit_price"] is None
    assert got["T4"]["product_id"] is None and got["T4"]["quantity"] is None
    assert got["T1"]["unit_price"] == 48.2
    assert df.schema["transaction_date"].dataType.simpleString() == "date"
    assert dt.date(2025, 1, 1) == got["T1"]["transaction_date"]


def test_cli_all_matches_the_catalog(spark):
    """fixtures + pipeline through the CLI; gold equals the oracle-checked catalog queries."""
    from salesmart import cli
    from salesmart.operators.checks import dataset_differences
    from salesmart.plans.catalog import catalog
    from tests.conftest import SF_SMALL

    base = scratch_uri(spark, "cli-test")
    report = cli.main(["all", "--no-defects", "--sf-dir", SF_SMALL,
                       "--raw-dir", f"{base}/raw", "--warehouse-dir", f"{base}/wh"])
    assert report["input_rows"] == 6000 and report["accepted_rows"] == 3539
    layout = Layout(f"{base}/raw", f"{base}/wh")
    cat = catalog()
    for name in GOLD_TABLES:
        written = spark.read.parquet(layout.gold_path(name))
        assert dataset_differences(written, cat[name](spark, SF_SMALL)).count() == 0, name
    quarantine = spark.read.parquet(layout.quarantine_sales_path)
    reasons = {r["quality_reason"]: r["n"] for r in quarantine.groupBy("quality_reason").agg(F.count("*").alias("n")).collect()}
    expected = {r["quality_reason"]: r["row_count"] for r in cat["rejection_reasons"](spark, SF_SMALL).collect()}
    assert reasons == expected


def test_release_empties_a_scratch_table(spark):
    from salesmart.sources.files import release

    path = scratch_uri(spark, "release")
    spark.range(100).write.parquet(path)
    release(spark, path)
    assert spark.read.parquet(path).count() == 0


def test_every_csv_file_header_is_validated(spark):
    # A second file with a reordered header in the same directory fails the scan:
    # every file's header is checked, not only the first one.
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    path = scratch_uri(spark, "two-headers")
    df = tables(spark, clean_lines(4))["sales_transactions"]
    cols = df.columns
    write_csv(df.limit(2).coalesce(1), path)
    write_csv(df.select(cols[1], cols[0], *cols[2:]).coalesce(1), path, mode="append")
    with pytest.raises((Py4JJavaError, PySparkException)):
        read_csv(spark, path, SALES_SCHEMA, check_columns=False).collect()


def test_job_on_empty_sales(spark):
    base = scratch_uri(spark, "empty-job")
    layout = Layout(f"{base}/raw", f"{base}/warehouse")
    t = tables(spark, [])
    write_raw_dataset(spark, t, layout, order_by=[], sales_files=1)
    report = run(spark, layout)
    assert (report["input_rows"], report["accepted_rows"], report["rejected_rows"]) == (0, 0, 0)
    assert report["rejection_reasons"] == {}
    assert spark.read.parquet(layout.gold_path("metric_overview_daily")).count() == 0
