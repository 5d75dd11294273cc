"""Atomic control files and outputs, dataset fingerprints, joins with heavy keys."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from salesmart.operators import checks, enrich
from salesmart.plans.job import run
from salesmart.schemas import SchemaContractError
from salesmart.session import scratch_uri
from salesmart.sources.files import publish, read_json_file, write_csv, write_json_file
from salesmart.sources.fixtures import write_raw_dataset
from salesmart.sources.layout import Layout
from tests.fixtures import clean_lines, products, tables


def local(uri: str) -> str:
    return uri.removeprefix("file:")


def test_json_file_is_replaced_whole_or_not_at_all(spark):
    path = scratch_uri(spark, "report") + "/report.json"
    write_json_file(spark, {"n": 1}, path)
    write_json_file(spark, {"n": 2}, path)
    assert read_json_file(spark, path) == {"n": 2}
    assert [n for n in os.listdir(os.path.dirname(local(path))) if not n.startswith(".")] == ["report.json"]


def test_json_write_that_fails_before_the_rename_leaves_the_old_file(spark):
    # a directory in the file's place refuses the last step, the rename
    path = scratch_uri(spark, "report") + "/report.json"
    os.makedirs(local(path))
    open(f"{local(path)}/old", "w").close()
    with pytest.raises(Exception, match="."):
        write_json_file(spark, {"n": 1}, path)
    assert os.listdir(local(path)) == ["old"]
    assert os.listdir(os.path.dirname(local(path))) == ["report.json"]  # no draft is left


def test_publish_puts_everything_back_if_one_move_fails(spark):
    base = scratch_uri(spark, "publish")
    for name in ("a", "b"):
        spark.range(1).write.parquet(f"{base}/live/{name}")
    spark.range(5).write.parquet(f"{base}/new/a")
    moves = {f"{base}/new/{n}": f"{base}/live/{n}" for n in ("a", "b")}
    with pytest.raises(Exception, match="."):
        publish(spark, moves)  # there is no new b
    assert [spark.read.parquet(f"{base}/live/{n}").count() for n in ("a", "b")] == [1, 1]
    assert sorted(os.listdir(local(f"{base}/live"))) == ["a", "b"]
    assert spark.read.parquet(f"{base}/new/a").count() == 5
    spark.range(6).write.parquet(f"{base}/new/b")
    publish(spark, moves)
    assert [spark.read.parquet(f"{base}/live/{n}").count() for n in ("a", "b")] == [5, 6]
    assert sorted(os.listdir(local(f"{base}/live"))) == ["a", "b"]


def test_a_run_that_fails_leaves_the_earlier_outputs(spark):
    base = scratch_uri(spark, "failing-run")
    layout = Layout(f"{base}/raw", f"{base}/wh")
    t = tables(spark, clean_lines(12))
    write_raw_dataset(spark, t, layout, order_by=[], sales_files=1)
    report = run(spark, layout)
    listing = sorted(os.listdir(local(f"{base}/wh")))
    assert not [n for n in listing if n.startswith("incoming")]
    stores = t["stores"]
    cols = stores.columns
    write_csv(stores.select(cols[1], cols[0], *cols[2:]), layout.stores_path)
    with pytest.raises(SchemaContractError):
        run(spark, layout)
    assert sorted(os.listdir(local(f"{base}/wh"))) == listing
    assert read_json_file(spark, layout.quality_report_path) == report
    assert spark.read.parquet(layout.silver_sales_path).count() == 12


def test_equal_datasets_have_no_differing_bucket(spark):
    a = spark.range(5000).select(F.col("id") % 700, F.concat(F.lit("x"), F.col("id") % 13), (F.col("id") * 0.5))
    a = a.toDF("k", "t", "m")
    b = a.repartition(7).orderBy(F.rand(3))
    assert checks.differing_buckets(a, b).count() == 0
    assert checks.dataset_differences(a, b).count() == 0
    more = b.unionByName(spark.createDataFrame([(1, "x1", 0.5), (None, None, float("nan"))], b.schema))
    assert checks.differing_buckets(a, more).count() == 2
    rows = checks.dataset_differences(a, more).collect()
    assert sorted(r["side"] for r in rows) == ["right_only", "right_only"]
    assert checks.dataset_differences(more, more).count() == 0


def test_only_rows_of_differing_buckets_are_compared(spark):
    a = spark.range(20_000).withColumn("v", F.col("id") * 2)
    b = a.where("id != 77")
    differ = checks.differing_buckets(a, b).collect()
    assert len(differ) == 1
    rows = checks.dataset_differences(a, b).collect()
    assert [(r["side"], r["id"]) for r in rows] == [("left_only", 77)]
    with pytest.raises(ValueError, match="power of two"):
        checks.differing_buckets(a, b, buckets=1000)


def _skewed(spark, n=12_000):
    """A third of the lines has one product, a sixth no product id."""
    kind = F.col("id") % 6
    key = F.when(kind < 2, F.lit("P001")).when(kind == 2, None).otherwise(F.concat(F.lit("X"), F.col("id") % 500))
    return spark.range(n).select(key.alias("product_id"), "id")


def test_heavy_keys_are_found(spark):
    assert [r["_heavy"] for r in enrich.heavy_keys(_skewed(spark), "product_id").collect()] == ["P001"]


def test_join_with_split_heavy_keys_is_even_and_equal(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines, dim = _skewed(spark), products(spark)

        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

        plain = enrich.join_products(lines, dim)
        split = enrich.join_products(lines, dim, split_heavy=True)
        assert split.columns == plain.columns
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
        assert max(sizes(plain)) > 4000
        assert max(sizes(split)) < 2.5 * 12_000 / 16
        assert "SortMergeJoin" in split._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_job_with_split_heavy_keys_writes_the_same(spark):
    base = scratch_uri(spark, "heavy-job")
    layout = Layout(f"{base}/raw", f"{base}/wh")
    write_raw_dataset(spark, tables(spark, clean_lines(20)), layout, order_by=[], sales_files=1)
    run(spark, layout)
    whole = spark.read.parquet(layout.silver_sales_path).collect()
    run(spark, layout, split_heavy=True)
    again = spark.read.parquet(layout.silver_sales_path).collect()
    assert sorted(map(str, whole)) == sorted(map(str, again))


def test_cli_directories_have_defaults():
    from salesmart import cli

    assert (cli.RAW_DIR, cli.WAREHOUSE_DIR) == ("data/raw", "data/warehouse")
    with pytest.raises(SystemExit):
        cli.main(["all"])  # the driver tables have none
