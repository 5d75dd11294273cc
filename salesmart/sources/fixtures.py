"""Raw dataset writer (G9, G13): the four raw tables as header CSVs + a manifest.

Stands in for the source's single-process generator: the tables come from
the driver data through the retail adapter (optionally with the three
known-bad lines appended) and are written by Spark. The sales file is
range-partitioned by transaction id and sorted inside each file by the
source order, so the copies of a transaction follow each other in source
order and the ingest order (file, place in the file) reproduces it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.defects import inject_quality_issues, require_rows
from salesmart.operators.report import REPORT_TIMEZONE
from salesmart.schemas import SCHEMAS
from salesmart.sources import retailview as rv
from salesmart.sources.files import write_csv, write_json_file
from salesmart.sources.layout import RAW_FILES, Layout

# Manifest labels of the encoded trends and injected issues.
KNOWN_PATTERNS = [
    "black_friday_electronics_growth",
    "weekend_sales_effect",
    "online_channel_growth",
    "december_holiday_shopping",
]
INJECTED_QUALITY_ISSUES = ["duplicate_transaction", "invalid_price", "unknown_product"]


def sales_in_source_order(
    sales: DataFrame, order_by: Sequence[str], files: int | None, transaction_id: Column | str = "transaction_id"
) -> DataFrame:
    """Range-partition on (transaction id, source order) and sort each file.

    The range includes the order columns, so a transaction with very many
    copies spreads over consecutive files instead of one task. Without a
    file count the files follow the data's size (adaptive coalescing).
    ``transaction_id``: formed from other columns, where the lines have no such column.
    """
    keys = [transaction_id, *order_by]
    ranged = sales.repartitionByRange(files, *keys) if files else sales.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_raw_dataset(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    layout: Layout,
    order_by: Sequence[str] = rv.SOURCE_ORDER,
    sales_files: int | None = None,
    ordered: bool = False,
) -> dict[str, int]:
    """Write the four CSVs (the sales lines gzipped) and return their row counts (observed while writing).

    ``ordered``: the sales lines are in source order already.
    """
    counts = {}
    for name, df in tables.items():
        if name == "sales_transactions" and not ordered:
            df = sales_in_source_order(df, order_by, sales_files)
        seen = Observation(f"written_{name}")
        write_csv(
            df.select(*SCHEMAS[name].fieldNames()).observe(seen, F.count(F.lit(1)).alias("n")),
            layout.raw_path(name),
            compression="gzip" if name == "sales_transactions" else "none",
        )
        counts[name] = seen.get["n"]
    return counts


def write_manifest(
    spark: SparkSession, layout: Layout, counts: dict[str, int], injected: bool
) -> dict:
    now = _dt.datetime.now(ZoneInfo(REPORT_TIMEZONE)).replace(microsecond=0)
    manifest = {
        "generated_at": now.isoformat(),
        "timezone": REPORT_TIMEZONE,
        "counts": counts,
        "paths": dict(RAW_FILES),
        "known_patterns": list(KNOWN_PATTERNS),
        "injected_quality_issues": list(INJECTED_QUALITY_ISSUES) if injected else [],
    }
    write_json_file(spark, manifest, layout.manifest_path)
    return manifest


def build_raw_dataset(
    spark: SparkSession,
    sf_dir: str,
    layout: Layout,
    inject_defects: bool = True,
    sales_files: int | None = None,
) -> dict:
    """Driver tables -> raw CSVs (+ the three known-bad lines) -> manifest.

    The ingest order of several files is (file, place in the file), which is
    the written order whatever the number of files. Without the bad lines the
    narrow source lines are put in order, and the contract columns formed after.
    """
    in_order = None
    if not inject_defects:
        def in_order(lines: DataFrame) -> DataFrame:
            return sales_in_source_order(lines, rv.SOURCE_ORDER, sales_files, rv.transaction_id())
    tables = rv.raw_tables(spark, sf_dir, rv.raw_sales(spark, sf_dir, arrange=in_order))
    if inject_defects:
        sales = tables["sales_transactions"]
        require_rows(sales, 3)  # reads at most 3 lines
        start = sales.agg(F.min("transaction_date").alias("start"))
        tables["sales_transactions"] = inject_quality_issues(
            sales, ["transaction_id", *rv.SOURCE_ORDER], start
        )
    counts = write_raw_dataset(spark, tables, layout, sales_files=sales_files, ordered=not inject_defects)
    return write_manifest(spark, layout, counts, inject_defects)
