"""Query catalog: one builder per operator key of the inventory.

Every builder takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` through the retail adapter and returns a lazy DataFrame over
the whole tables. Public money columns are DOUBLE (exact DECIMAL inside).
Builders for sinks write to a fresh location under the shared
``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from salesmart.operators import checks, defects, patterns, report
from salesmart.operators.calendar import calendar_from_bounds
from salesmart.operators.dedup import DUPLICATE_RANK, rank_duplicates, rank_split
from salesmart.operators.enrich import join_calendar, join_products, join_stores
from salesmart.operators.normalize import add_source_row_id, line_measures, normalize_sales
from salesmart.operators.quality import QUALITY_REASON, REASONS, RULES_BY_REASON, rule_hits
from salesmart.plans import gold, gold_sql, job, lattice
from salesmart.plans.bronze import bronze_tables
from salesmart.plans.silver import (
    accepted_sales,
    checked_sales,
    enriched_sales,
    quarantine_from_checked,
    ranked_sales,
    read_silver,
    store_silver,
)
from salesmart.schemas import MONEY, SALES_COLUMNS, SALES_SCHEMA
from salesmart.session import scratch_uri
from salesmart.sources import files
from salesmart.sources import retailview as rv
from salesmart.sources.fixtures import build_raw_dataset, sales_in_source_order
from salesmart.sources.layout import Layout

Builder = Callable[[SparkSession, str], DataFrame]
ROW_ID = ["transaction_id", *rv.SOURCE_ORDER]
RAW_FILE_COUNT = 7  # at least; a file is one task's work, so more lines make more files
LINES_PER_FILE = 500_000
SILVER_MONTH = (1995, 3)
MONEY_EDGES = ("0.004", "-0.004", "NaN", "1e17", "1.005", "")


def public(df: DataFrame) -> DataFrame:
    """Cast DECIMAL money to DOUBLE for the public result."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return rv.raw_tables(spark, d)


def _ranked_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The raw tables; the sales lines with their ranks, taken on the narrow source lines."""
    lines = rank_split(rv.sales_lines(spark, d), order_by=rv.SOURCE_ORDER)
    return rv.raw_tables(spark, d, rv.raw_sales(spark, d, lines))


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return checked_sales(_ranked_tables(spark, d), rv.SOURCE_ORDER)


def _first_copies(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The raw tables; of the sales lines the ranks are taken on the narrow source lines, for silver.

    Order and part give a line one row each, as only one line of a transaction is accepted.
    """
    lines = rank_duplicates(rv.sales_lines(spark, d), order_by=rv.SOURCE_ORDER, skew=None)
    return rv.raw_tables(spark, d, rv.raw_sales(spark, d, lines, one_each=True))


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return accepted_sales(_first_copies(spark, d), rv.SOURCE_ORDER)


def _input_rows(spark: SparkSession, d: str) -> DataFrame:
    return report.count_rows(rv.sales_keys(spark, d))


# -- sources and sinks (A1-A4, A10, G9, G14) ---------------------------------

def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_uri(spark, "csv_roundtrip")
    files.write_csv(rv.raw_sales(spark, d).select(*SALES_COLUMNS), path)
    return public(files.read_csv(spark, path, SALES_SCHEMA))


def parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_uri(spark, "parquet_roundtrip")
    files.write_parquet(rv.raw_sales(spark, d), path)
    return public(files.read_parquet(spark, path))


def bronze_ingest(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_uri(spark, "bronze")
    bronze = bronze_tables(spark, _tables(spark, d), root)
    parts = [
        t.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("ingested_at").alias("distinct_ingest_times"),
        ).select(F.lit(name).alias("table_name"), "row_count", "distinct_ingest_times")
        for name, t in bronze.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_contract(spark: SparkSession, d: str) -> DataFrame:
    """Per contract column: position, type and NULL count after a checked CSV read."""
    path = scratch_uri(spark, "schema_contract")
    files.write_csv(rv.raw_sales(spark, d).select(*SALES_COLUMNS), path)
    df = files.read_csv(spark, path, SALES_SCHEMA)  # raises on a header mismatch
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in SALES_COLUMNS])
    stack = ", ".join(
        f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', `{f.name}`"
        for i, f in enumerate(SALES_SCHEMA.fields)
    )
    return nulls.select(
        F.expr(f"stack({len(SALES_COLUMNS)}, {stack}) AS (position, column_name, data_type, null_count)")
    )


def csv_file_order_rank(spark: SparkSession, d: str) -> DataFrame:
    """Keep-first rank of raw CSVs in many files, by (file, place in the file)."""
    path = scratch_uri(spark, "csv_file_order")
    files_needed = max(RAW_FILE_COUNT, -(-rv.sales_keys(spark, d).count() // LINES_PER_FILE))
    sales = sales_in_source_order(rv.raw_sales(spark, d), rv.SOURCE_ORDER, files_needed)
    files.write_csv(sales.select(*SALES_COLUMNS), path)
    raw = files.read_csv(spark, path, SALES_SCHEMA, origin=True)
    bronze = bronze_tables(spark, {"sales_transactions": raw}, scratch_uri(spark, "bronze"))
    ranked = ranked_sales(bronze["sales_transactions"])
    return public(ranked.select("transaction_id", "product_id", "quantity", "gross_revenue", DUPLICATE_RANK))


def csv_money_edge(spark: SparkSession, d: str) -> DataFrame:
    """Price, cost and revenue rules on sub-cent, NaN and very large amounts read from CSV."""
    path = scratch_uri(spark, "csv_money_edge")
    amounts = [F.lit(x) for x in MONEY_EDGES]
    columns = ("unit_price", "unit_cost", "net_revenue")
    edges = {}
    for k, c in enumerate(columns):
        pick = F.pmod(F.col("_src_partkey") + k, F.lit(len(MONEY_EDGES) + 2)).cast("int")
        edges[c] = F.coalesce(F.get(F.array(*amounts), pick), F.col(c).cast("string"))
    raw = rv.raw_sales(spark, d).withColumns(edges)
    files.write_csv(raw.select(*SALES_COLUMNS), path)
    read = files.read_csv(spark, path, SALES_SCHEMA)
    return read.select(
        "transaction_id",
        "product_id",
        *[
            F.coalesce(RULES_BY_REASON[r].fires(), F.lit(False)).alias(r)
            for r in ("invalid_unit_price", "invalid_unit_cost", "invalid_net_revenue")
        ],
        *[F.round(F.nanvl(c, F.lit(-1.0)) * 1000, 0).alias(f"{c}_mills") for c in columns],
    )


# -- projections, window, joins (B1-B8, F1, D1-D4) ---------------------------

def source_row_id(spark: SparkSession, d: str) -> DataFrame:
    ids = add_source_row_id(rv.raw_sales(spark, d).select(*SALES_COLUMNS))
    return ids.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("_source_row_id").alias("distinct_ids"),
    )


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    n = normalize_sales(rv.raw_sales(spark, d))
    return n.select(*ROW_ID, "channel", "order_status", "product_id", "store_id")


def duplicate_rank(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select(*ROW_ID, DUPLICATE_RANK)


def realized_measures(spark: SparkSession, d: str) -> DataFrame:
    return public(_silver(spark, d).select("transaction_id", "order_status", "realized_revenue", "realized_margin"))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return ranked_sales(_ranked_tables(spark, d)["sales_transactions"], rv.SOURCE_ORDER)


def join_products_q(spark: SparkSession, d: str) -> DataFrame:
    j = join_products(_ranked(spark, d), rv.products(spark, d))
    return public(j.select(*ROW_ID, "product_id", "product_name", "category", "brand",
                           "base_price", "base_cost", "launch_date", "is_active"))


def join_stores_q(spark: SparkSession, d: str) -> DataFrame:
    j = join_stores(_ranked(spark, d), rv.stores(spark, d))
    return j.select(*ROW_ID, "store_id", "city", "region", "store_type", "opened_at", "population_segment")


def join_calendar_q(spark: SparkSession, d: str) -> DataFrame:
    j = join_calendar(_ranked(spark, d), rv.calendar(spark, d))
    return j.select(*ROW_ID, "transaction_date", "year", "quarter", "month", "month_name",
                    "week_of_year", "day_of_week", "is_weekend", "holiday_name", "season")


def enriched_sales_q(spark: SparkSession, d: str) -> DataFrame:
    return public(enriched_sales(_ranked_tables(spark, d), rv.SOURCE_ORDER))


# -- rules and split (C1-C17, J2) ---------------------------------------------

def quality_reason(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select(*ROW_ID, QUALITY_REASON)


def _rule_builder(reason: str) -> Builder:
    def build(spark: SparkSession, d: str) -> DataFrame:
        return rule_hits(_checked(spark, d), reason).select(*ROW_ID)

    build.__name__ = f"rule_{reason}"
    return build


def silver_sales(spark: SparkSession, d: str) -> DataFrame:
    return public(_silver(spark, d))


def quarantine_sales(spark: SparkSession, d: str) -> DataFrame:
    return public(quarantine_from_checked(_checked(spark, d)))


# -- gold and report (E1-E21, G13, G15) ----------------------------------------

def _gold_builder(name: str) -> Builder:
    def build(spark: SparkSession, d: str) -> DataFrame:
        return gold.gold_table(_silver(spark, d), name)

    build.__name__ = name
    return build


def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    return report.rejection_reasons(quarantine_from_checked(_checked(spark, d)))


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return report.report_counts(_input_rows(spark, d), _checked(spark, d))


def check_row_accounting(spark: SparkSession, d: str) -> DataFrame:
    return report.row_accounting(_input_rows(spark, d), _checked(spark, d))


def dataset_manifest(spark: SparkSession, d: str) -> DataFrame:
    return report.table_counts(_tables(spark, d))


# -- calendar, dimensions, measures (G1-G7) ------------------------------------

def calendar_dim(spark: SparkSession, d: str) -> DataFrame:
    """Calendar over the orders' whole date range."""
    return calendar_from_bounds(rv.order_date_range(spark, d))


def calendar_season(spark: SparkSession, d: str) -> DataFrame:
    return calendar_dim(spark, d).select("date", "month", "season")


def calendar_holiday(spark: SparkSession, d: str) -> DataFrame:
    return calendar_dim(spark, d).where(F.col("holiday_name").isNotNull()).select("date", "holiday_name")


def line_measures_q(spark: SparkSession, d: str) -> DataFrame:
    """Line measures recomputed from quantity, price, discount and unit cost."""
    sales = rv.raw_sales(spark, d)
    inputs = sales.select(
        *ROW_ID,
        "quantity",
        "unit_price",
        "discount_percent",
        "unit_cost",
        "order_status",
    )
    return public(
        inputs.select(
            *ROW_ID,
            *line_measures(
                F.col("quantity"), F.col("unit_price"), F.col("discount_percent"),
                F.col("unit_cost"), F.col("order_status"),
            ),
        )
    )


def product_dim(spark: SparkSession, d: str) -> DataFrame:
    return public(rv.products(spark, d))


def store_dim(spark: SparkSession, d: str) -> DataFrame:
    return rv.stores(spark, d)


# -- defects and checks (G8, G10-G12) ------------------------------------------

def _start(spark: SparkSession, d: str) -> DataFrame:
    return rv.raw_sales(spark, d).agg(F.min("transaction_date").alias("start"))


def _with_defects(spark: SparkSession, d: str) -> DataFrame:
    sales = rv.raw_sales(spark, d)
    return defects.inject_quality_issues(sales, ROW_ID, _start(spark, d))


def inject_defects(spark: SparkSession, d: str) -> DataFrame:
    return public(_with_defects(spark, d))


def check_order_metadata(spark: SparkSession, d: str) -> DataFrame:
    return checks.order_metadata_conflicts(rv.raw_sales(spark, d))


def order_line_histogram(spark: SparkSession, d: str) -> DataFrame:
    return checks.order_line_histogram(rv.raw_sales(spark, d))


def check_dataset_equal(spark: SparkSession, d: str) -> DataFrame:
    return public(checks.dataset_differences(rv.raw_sales(spark, d), _with_defects(spark, d)))


# -- pattern analyses (G16-G19) ------------------------------------------------

def pattern_event_category_share(spark: SparkSession, d: str) -> DataFrame:
    return patterns.category_share_event_window(_silver(spark, d))


def pattern_weekend_effect(spark: SparkSession, d: str) -> DataFrame:
    return patterns.weekend_effect(_silver(spark, d))


def pattern_channel_share_monthly(spark: SparkSession, d: str) -> DataFrame:
    return patterns.channel_share_monthly(_silver(spark, d))


def pattern_category_share_monthly(spark: SparkSession, d: str) -> DataFrame:
    return patterns.category_share_monthly(_silver(spark, d))


def pattern_category_share_season(spark: SparkSession, d: str) -> DataFrame:
    return patterns.category_share_season(_silver(spark, d))


def _sql_builder(name: str) -> Builder:
    def build(spark: SparkSession, d: str) -> DataFrame:
        return gold_sql.gold_table_sql(spark, _silver(spark, d), name)

    build.__name__ = f"sql_{name}"
    return build


# -- written layers: partitioned silver, stored partials, DOUBLE money, the whole job ---

def _stored_silver(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_uri(spark, "silver")
    with files.shuffle_files_freed(spark):
        store_silver(_silver(spark, d), path)
    return read_silver(spark, path, MONEY)


def silver_month_pruned(spark: SparkSession, d: str) -> DataFrame:
    """One month of the stored silver lines, read from its directories alone."""
    year, month = SILVER_MONTH
    return public(_stored_silver(spark, d).where((F.col("year") == year) & (F.col("month") == month)))


def _partials_builder(name: str) -> Builder:
    """A gold table finished from the stored partials of two batches that share days and orders."""

    def build(spark: SparkSession, d: str) -> DataFrame:
        root = scratch_uri(spark, "partials")
        silver = _stored_silver(spark, d)
        late = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
        with files.shuffle_files_freed(spark):
            lattice.write_partials(silver.where(~late), root, "first")
            lattice.write_partials(silver.where(late), root, "late")
        return lattice.gold_from(*lattice.read_partials(spark, root))[name]

    build.__name__ = f"partials_{name}"
    return build


def _double_sql_builder(name: str) -> Builder:
    """A gold table by SQL over silver lines with DOUBLE money, as the job stores them."""

    def build(spark: SparkSession, d: str) -> DataFrame:
        return gold_sql.gold_table_sql(spark, public(_silver(spark, d)), name)

    build.__name__ = f"sql_double_{name}"
    return build


def _summed_cents(column: str) -> Column:
    return F.sum(F.round(F.col(column) * 100).cast("long"))


def job_outputs(spark: SparkSession, d: str) -> DataFrame:
    """What a whole run writes: rows, a sum and cents of every table, and the numbers of the report."""
    base = scratch_uri(spark, "job")
    layout = Layout(f"{base}/raw", f"{base}/warehouse")
    with files.shuffle_files_freed(spark):
        build_raw_dataset(spark, d, layout, inject_defects=False)
    job.run(spark, layout)
    report_read = job.read_report(spark, layout.quality_report_path)
    none = F.lit(None).cast("long")
    sales = files.read_parquet(spark, f"{layout.bronze_dir}/sales_transactions")
    quarantine = files.read_parquet(spark, layout.quarantine_sales_path)
    parts = [
        ("bronze.sales_transactions", sales, F.sum("quantity"), _summed_cents("net_revenue")),
        ("silver", read_silver(spark, layout.silver_sales_path), F.sum("quantity"), _summed_cents("realized_revenue")),
        ("quarantine", quarantine, F.sum(DUPLICATE_RANK), _summed_cents("net_revenue")),
    ]
    parts += [
        (f"bronze.{n}", files.read_parquet(spark, f"{layout.bronze_dir}/{n}"), none, none)
        for n in ("products", "stores", "calendar")
    ]
    parts += [
        (f"gold.{n}", files.read_parquet(spark, layout.gold_path(n)), F.sum("units_sold"), _summed_cents("net_revenue"))
        for n in gold.GOLD_TABLES
    ]
    numbers = [(f"report.{c}", report_read[c]) for c in report.COUNT_COLUMNS]
    numbers += [(f"reason.{r}", n) for r, n in report_read["rejection_reasons"].items()]
    out = spark.createDataFrame(numbers, "output string, row_count long").select(
        "output", "row_count", none.alias("total"), none.alias("cents")
    )
    for name, table, total, in_cents in parts:
        row = table.agg(F.count(F.lit(1)).alias("row_count"), total.alias("total"), in_cents.alias("cents"))
        out = out.unionByName(row.select(F.lit(name).alias("output"), "row_count", "total", "cents"))
    return out


def catalog() -> dict[str, Builder]:
    out: dict[str, Builder] = {
        "csv_roundtrip": csv_roundtrip,
        "parquet_roundtrip": parquet_roundtrip,
        "bronze_ingest": bronze_ingest,
        "schema_contract": schema_contract,
        "csv_file_order_rank": csv_file_order_rank,
        "csv_money_edge": csv_money_edge,
        "source_row_id": source_row_id,
        "normalize_text": normalize_text,
        "duplicate_rank": duplicate_rank,
        "realized_measures": realized_measures,
        "join_products": join_products_q,
        "join_stores": join_stores_q,
        "join_calendar": join_calendar_q,
        "enriched_sales": enriched_sales_q,
        "quality_reason": quality_reason,
    }
    for reason in REASONS:
        out[f"rule_{reason}"] = _rule_builder(reason)
    out["silver_sales"] = silver_sales
    out["quarantine_sales"] = quarantine_sales
    for name in gold.GOLD_TABLES:
        out[name] = _gold_builder(name)
    out.update(
        {
            "rejection_reasons": rejection_reasons,
            "quality_report": quality_report,
            "check_row_accounting": check_row_accounting,
            "dataset_manifest": dataset_manifest,
            "calendar_dim": calendar_dim,
            "calendar_season": calendar_season,
            "calendar_holiday": calendar_holiday,
            "line_measures": line_measures_q,
            "product_dim": product_dim,
            "store_dim": store_dim,
            "inject_defects": inject_defects,
            "check_order_metadata": check_order_metadata,
            "order_line_histogram": order_line_histogram,
            "check_dataset_equal": check_dataset_equal,
            "pattern_event_category_share": pattern_event_category_share,
            "pattern_weekend_effect": pattern_weekend_effect,
            "pattern_channel_share_monthly": pattern_channel_share_monthly,
            "pattern_category_share_monthly": pattern_category_share_monthly,
            "pattern_category_share_season": pattern_category_share_season,
        }
    )
    for name in gold.GOLD_TABLES:
        out[f"sql_{name}"] = _sql_builder(name)
        out[f"sql_double_{name}"] = _double_sql_builder(name)
    out["silver_month_pruned"] = silver_month_pruned
    for name in ("metric_overview_daily", "sales_by_city_daily"):
        out[f"partials_{name}"] = _partials_builder(name)
    out["job_outputs"] = job_outputs
    return out
