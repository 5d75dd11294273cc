"""The whole batch run (J4, J5): raw CSV -> bronze -> silver / quarantine ->
gold -> quality report.

Execution shape (versus evaluating the silver lineage once per output):

1. The four CSVs are parsed once, into bronze Parquet (with the sales
   ingest order ``_source_row_id`` persisted).
2. The lines are ranked by transaction id and then joined with the products,
   moved once for each and stored as scratch Parquet after each (a stored line
   takes far fewer bytes than a shuffled one), by month after the products.
   Silver and quarantine are two complementary filters of that scan after
   joins to small tables, each written once into its final layout. A scratch
   is deleted when the next step has read it, and a step's shuffle files with
   the step, so the disk holds those of one step at a time.
3. Silver is partitioned by year and month. Large months are read where they
   are stored, over several tasks and files, and not moved again; the lines of
   small ones are dealt out by month before stores and calendar widen them.
4. Gold reads silver twice: one base aggregate at the finest grain and one by
   (day, order); the five tables are finished from these stored partials
   (``plans.lattice``).
5. The report is one grouped count of the quarantine's reason column (at
   most one row for each reason combination reaches the driver) and row
   counts of the written tables (Parquet footers).
6. Everything is written to a directory of the run first and published by
   renames at the end, so a run that fails leaves the earlier outputs whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.dedup import DEFAULT_SKEW, SkewPolicy
from salesmart.operators.enrich import enrich_further, few_stores
from salesmart.operators.quality import QUALITY_REASON, accepted_only, add_quality_reason, rejected_only
from salesmart.operators.report import counts_of_reasons, report_document
from salesmart.plans.actions import concurrently
from salesmart.plans.bronze import read_bronze, without_ingest_time, write_bronze
from salesmart.plans.lattice import write_gold, write_partials
from salesmart.plans.silver import (
    MONTH_START,
    ranked_lines,
    read_silver,
    sales_with_products,
    to_silver,
    with_month_start,
    write_silver,
)
from salesmart.schemas import SCHEMAS, TABLE_NAMES
from salesmart.session import scratch_uri
from salesmart.sources.files import (
    publish,
    read_by_directory,
    read_csv,
    read_json_file,
    read_parquet,
    release,
    remove,
    shuffle_files_freed,
    write_json_file,
    write_parquet,
)
from salesmart.sources.layout import Layout

SALES_TABLE = "sales_transactions"
FIRST_BATCH = "run"


def load_raw_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The four raw CSVs, header-checked and read with their schemas (A2).

    The four up-front header checks are small independent jobs, run together.
    """
    frames = concurrently(
        *[
            (lambda n=name: read_csv(spark, layout.raw_path(n), SCHEMAS[n], origin=n == SALES_TABLE))
            for name in TABLE_NAMES
        ]
    )
    return dict(zip(TABLE_NAMES, frames))


def reason_counts(quarantine: DataFrame) -> dict[str, int]:
    """Rejected lines per reason combination; at most 2**rules rows reach the driver."""
    rows = quarantine.groupBy(QUALITY_REASON).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[QUALITY_REASON]: int(r["n"]) for r in rows}


def run(
    spark: SparkSession,
    layout: Layout,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    split_heavy: bool = False,
) -> dict:
    """Run every layer and return the quality report (also written as JSON).

    ``skew`` controls when a transaction id is split across tasks for the
    duplicate rank (None: one plain window).

    ``split_heavy`` is for products or stores beyond the broadcast size (see
    ``operators.enrich``).
    """
    incoming = layout.incoming(uuid.uuid4().hex[:12])
    try:
        with shuffle_files_freed(spark):
            document = _written(spark, incoming, order_by, skew, split_heavy)
        publish(spark, {getattr(incoming, d): getattr(layout, d) for d in layout.published})
    finally:
        remove(spark, incoming.warehouse_uri)  # empty by now, or what a failed run wrote
    write_report(spark, document, layout.quality_report_path)
    return document


def _written(
    spark: SparkSession,
    layout: Layout,
    order_by: Sequence[str] | None,
    skew: SkewPolicy | None,
    split_heavy: bool,
) -> dict:
    """Every layer written under ``layout``; returns the report."""
    raw = load_raw_tables(spark, layout)
    bronze = read_bronze(spark, write_bronze(raw, layout.bronze_dir))
    tables = {name: without_ingest_time(df) for name, df in bronze.items()}
    # a calendar has a row for each day and is broadcast, so that the lines are not moved for it
    others = (tables["stores"], F.broadcast(tables["calendar"]), split_heavy)
    by_month = not split_heavy and few_stores(tables["stores"])
    with _stored_lines(spark, tables, order_by, skew, split_heavy, by_month) as (lines, dealt):
        write_lines(
            enrich_further(lines, *others),
            layout,
            enrich_further(dealt, *others) if by_month else None,
        )
    return _derived(spark, bronze, layout)


@contextmanager
def _stored_lines(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    order_by: Sequence[str] | None,
    skew: SkewPolicy | None,
    split_heavy: bool,
    by_month: bool,
) -> Iterator[tuple[DataFrame, DataFrame | None]]:
    """The ranked lines with the attributes of their product, from scratch Parquet that is deleted at the end.

    The ranks are stored first, so that the lines' moves for ranks and for products
    do not lie on the disk together. ``by_month``: stored by month, and also given
    dealt out by it.
    """
    if skew is not None:
        skew = replace(skew, workspace=scratch_uri(spark, "numbered-keys"))
    ranked, stored = scratch_uri(spark, "lines-with-ranks"), scratch_uri(spark, "lines-with-products")
    try:
        write_parquet(ranked_lines(tables[SALES_TABLE], order_by, skew), ranked)
        if skew is not None:
            release(spark, skew.workspace)  # nothing reads the numbered keys any more
        lines = sales_with_products(tables | {SALES_TABLE: read_parquet(spark, ranked)}, split_heavy=split_heavy)
        if by_month:
            lines = with_month_start(lines, tables["calendar"])
        write_parquet(lines, stored, partition_by=[MONTH_START] if by_month else None, dealt=by_month)
        remove(spark, ranked)
        dealt = read_by_directory(spark, stored, lines.schema, [MONTH_START]).drop(MONTH_START) if by_month else None
        yield spark.read.schema(lines.schema).parquet(stored).drop(MONTH_START), dealt
    finally:
        remove(spark, ranked)
        remove(spark, stored)


def write_lines(enriched: DataFrame, layout: Layout, by_month: DataFrame | None = None) -> None:
    """Accepted lines to silver, rejected ones to the quarantine: each line once, a job each.

    Silver filters on the rules' positive forms, so Catalyst makes its joins inner.
    ``by_month``: the same lines, dealt out by month already.
    """
    dealt = by_month is not None
    accepted = to_silver(accepted_only(by_month if dealt else enriched))
    concurrently(
        lambda: write_silver(accepted, layout.silver_sales_path, dealt),
        lambda: write_parquet(rejected_only(add_quality_reason(enriched)), layout.quarantine_sales_path),
    )


def _derived(spark: SparkSession, bronze: dict[str, DataFrame], layout: Layout) -> dict:
    """Gold from the written silver, and the report; returns the report."""
    silver = read_silver(spark, layout.silver_sales_path)

    def gold() -> None:
        write_partials(silver, layout.partials_dir, FIRST_BATCH)
        write_gold(spark, layout.partials_dir, layout.gold_dir)

    _, reasons, input_rows, accepted_rows = concurrently(
        gold,
        lambda: reason_counts(read_parquet(spark, layout.quarantine_sales_path)),
        bronze[SALES_TABLE].count,
        silver.count,
    )
    return report_document(counts_of_reasons(input_rows, accepted_rows, reasons), reasons)


def write_report(spark: SparkSession, document: dict, path: str) -> None:
    """The report as one JSON file (a control document, never table data)."""
    write_json_file(spark, document, path)


def read_report(spark: SparkSession, path: str) -> dict:
    return read_json_file(spark, path)
