"""What lies on the disk: lines gathered by month without a move, shuffle files and scratch gone with their step."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from salesmart.plans import catalog, job, silver
from salesmart.schemas import MONEY
from salesmart.session import checkpoint_root, scratch_uri
from salesmart.sources import files
from salesmart.sources.files import SHUFFLE_CLEANUP, _file_system, read_by_directory, shuffle_files_freed, write_parquet
from salesmart.sources.fixtures import build_raw_dataset
from tests.test_scale import _job_layout, _same, no_broadcast, sf_dir  # noqa: F401


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _moves(df) -> list[str]:
    return [x for x in _plan(df).splitlines() if "Exchange" in x and "Broadcast" not in x]


def _shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def _settles(spark, most: int) -> bool:
    """Whether no more than ``most`` shuffle files are left soon (they are deleted in the background)."""
    until = time.time() + 20
    while _shuffle_files(spark) > most and time.time() < until:
        time.sleep(0.2)
    return _shuffle_files(spark) <= most


def _scratch(spark) -> set[str]:
    fs, root = _file_system(spark, f"{checkpoint_root(spark)}/salesmart")
    return {s.getPath().getName().rsplit("-", 1)[0] for s in fs.listStatus(root)}


# -- F1, F2


def test_rows_are_gathered_by_directory_large_ones_in_place(spark, monkeypatch):
    path = scratch_uri(spark, "by-directory")
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 2900, F.when(F.col("id") < 2000, "a").otherwise("b")).alias("k")
    )
    write_parquet(df.repartition(5), path, partition_by=["k"], dealt=True)
    sizes = files.directory_sizes(spark, path, 1)
    assert len(sizes) == 3
    for large, moved in ((1, 0), (max(sizes.values()), 1), (1 << 40, 1)):
        monkeypatch.setattr(files, "LARGE_DIRECTORY", large)
        back = read_by_directory(spark, path, df.schema, ["k"])
        assert _same(df, back) and len(_moves(back)) == moved, large
    # the directories are read by tasks of their own, not all by one
    monkeypatch.setattr(files, "LARGE_DIRECTORY", 1)
    assert read_by_directory(spark, path, df.schema, ["k"]).rdd.getNumPartitions() >= 3


def test_no_stored_rows_are_no_rows(spark):
    path = scratch_uri(spark, "by-directory")
    none = spark.range(0).withColumn("k", F.lit(1))
    write_parquet(none, path, partition_by=["k"], dealt=True)
    back = read_by_directory(spark, path, none.schema, ["k"])
    assert back.columns == ["id", "k"] and back.count() == 0


def test_shuffle_files_go_with_their_query_and_the_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    left = _shuffle_files(spark)
    with shuffle_files_freed(spark):
        write_parquet(spark.range(1000).repartition(7), scratch_uri(spark, "freed"))
    assert _settles(spark, left)
    with pytest.raises(ZeroDivisionError), shuffle_files_freed(spark):
        1 / 0  # noqa: B018
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    with shuffle_files_freed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)


# -- F2


def test_stored_silver_is_not_moved_for_its_months(spark, sf_dir, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    write = silver.write_silver

    def noted(df, path, dealt=False):
        plans.append(_plan(df))
        write(df, path, dealt)

    monkeypatch.setattr(files, "LARGE_DIRECTORY", 1)
    monkeypatch.setattr(silver, "write_silver", noted)
    if hasattr(catalog, "write_silver"):
        monkeypatch.setattr(catalog, "write_silver", noted)
    left = _shuffle_files(spark)
    stored = catalog._stored_silver(spark, sf_dir)
    assert not [p for p in plans if "REBALANCE" in p]
    assert len(plans) == 2 and not [x for x in plans[1].splitlines() if "Exchange" in x]
    assert _settles(spark, left) and "silver-by-month" not in _scratch(spark)
    expected = catalog._silver(spark, sf_dir)
    assert stored.count() > 100 and _same(expected.select(*stored.columns), stored.select(*expected.columns))
    assert stored.schema["net_revenue"].dataType == MONEY


@pytest.mark.parametrize("name", ["metric_overview_daily", "sales_by_city_daily"])
def test_partials_leave_no_shuffle_files_of_their_writes(spark, sf_dir, name):  # noqa: F811
    left = _shuffle_files(spark)
    table = catalog.catalog()[f"partials_{name}"](spark, sf_dir)
    assert _settles(spark, left)
    assert _same(catalog.catalog()[name](spark, sf_dir), table)


# -- F1


def test_job_keeps_the_files_of_one_step_at_a_time(spark, sf_dir, no_broadcast, monkeypatch):  # noqa: F811
    layout, steps = _job_layout(spark), []
    build_raw_dataset(spark, sf_dir, layout, inject_defects=False)
    left = _shuffle_files(spark)
    write, lines = job.write_parquet, job.write_lines

    def noted(df, path, **options):
        scratch = path.rsplit("/", 1)[1].rsplit("-", 1)[0]
        if scratch.startswith("lines-with"):
            steps.append((scratch, len([x for x in _moves(df) if "hashpartitioning(" in x]), _settles(spark, left)))
        write(df, path, **options)

    def gathered(enriched, layout, by_month=None):
        steps.append(("by month", len(_moves(by_month)), _settles(spark, left)))
        assert "lines-with-ranks" not in _scratch(spark)
        lines(enriched, layout, by_month)

    monkeypatch.setattr(files, "LARGE_DIRECTORY", 1)
    monkeypatch.setattr(job, "write_parquet", noted)
    monkeypatch.setattr(job, "write_lines", gathered)
    job.run(spark, layout)
    # ranks; then the lines and the products, and the calendar's few months; then no move at all
    assert [(s, freed) for s, _, freed in steps] == [
        ("lines-with-ranks", True), ("lines-with-products", True), ("by month", True)
    ]
    assert steps[1][1] == 3 and steps[2][1] == 0
    assert _settles(spark, left) and not [s for s in _scratch(spark) if s.startswith("lines-with")]


def test_lines_are_stored_by_the_months_of_the_calendar_alone(spark):
    days = [dt.date(2025, 1, 31), dt.date(2025, 1, 1), dt.date(2025, 3, 5), dt.date(9999, 12, 31), dt.date(1, 1, 1), None]
    lines = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, transaction_date date")
    published = [dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 2, 1), dt.date(2025, 1, 1), None]
    calendar = spark.createDataFrame([(d,) for d in published], "date date")
    got = {r["i"]: r[silver.MONTH_START] for r in silver.with_month_start(lines, calendar).collect()}
    assert got == {0: "2025-01-01", 1: "2025-01-01", 2: None, 3: None, 4: None, 5: None}
