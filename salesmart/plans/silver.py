"""Silver / quarantine builders (J2): normalise -> rank -> enrich -> check -> split.

Two plan shapes give the same rows:

* ``checked_sales`` keeps every line with its ``quality_reason``; the
  quarantine and its report need it.
* ``accepted_sales`` needs silver only: the accept filter is an explicit
  AND of the rules' positive forms, so Catalyst converts the dimension
  joins to inner joins (pushing ``IS NOT NULL`` into the dimension scans)
  and turns the rank filter into a partial + final ``WindowGroupLimit``:
  each map task keeps only the first row per transaction before the
  shuffle, which also defuses a hot transaction id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from salesmart.operators.dedup import DEFAULT_SKEW, DUPLICATE_RANK, SkewPolicy, rank_duplicates, rank_split
from salesmart.operators.enrich import enrich, join_products
from salesmart.operators.normalize import SOURCE_ROW_ID, add_realized_measures, add_source_row_id, normalize_sales
from salesmart.operators.quality import QUALITY_REASON, accepted_only, add_quality_reason, rejected_only
from salesmart.schemas import CALENDAR_SCHEMA, PRODUCT_SCHEMA, RAW_MONEY, SALES_SCHEMA, STORE_SCHEMA
from salesmart.session import scratch_uri
from salesmart.sources.files import ORIGIN_COLUMNS, read_by_directory, remove, write_parquet

Tables = dict[str, DataFrame]


def _source_order(sales: DataFrame, order_by: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """The order of lines: as given, else by file and split (if known), then ingest id."""
    if order_by:
        return sales, list(order_by)
    if SOURCE_ROW_ID not in sales.columns:
        sales = add_source_row_id(sales)
    return sales, [*[c for c in ORIGIN_COLUMNS if c in sales.columns], SOURCE_ROW_ID]


def ranked_sales(
    sales: DataFrame,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Normalised lines with ``_duplicate_rank``.

    ``order_by`` names the source-order columns; by default the ingest
    ``_source_row_id`` (added here when the input has none). ``skew``
    splits hot transaction ids across tasks (None: one plain window, as for
    an id that was only just added and is not persisted). ``keys`` is a
    cheaper frame of the same transaction ids and order columns, if any.
    Lines that come with their rank, taken before they were widened, keep it.
    """
    if DUPLICATE_RANK in sales.columns:
        return normalize_sales(sales)
    persisted = bool(order_by) or SOURCE_ROW_ID in sales.columns
    sales, order = _source_order(sales, order_by)
    skew = skew if persisted else None
    ranked = rank_duplicates(normalize_sales(sales), order_by=order, skew=skew, lines=keys)
    return ranked.drop(*[c for c in ORIGIN_COLUMNS if c in order])


def enriched_sales(
    tables: Tables,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    keys: DataFrame | None = None,
    split_heavy: bool = False,
    by_month: bool = False,
) -> DataFrame:
    """Ranked lines with the attributes of their product, store and day (``split_heavy``, ``by_month``: see ``enrich``)."""
    return enrich(
        ranked_sales(tables["sales_transactions"], order_by, skew, keys),
        tables["products"],
        tables["stores"],
        tables["calendar"],
        split_heavy,
        by_month,
    )


def ranked_lines(
    sales: DataFrame, order_by: Sequence[str] | None = None, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Normalised lines with their ranks, for storing.

    The lines have persisted order columns, as bronze has them, and are moved
    once (heavy ids are ranked apart, see ``rank_split``).
    """
    sales, order = _source_order(sales, order_by)
    if skew is not None:
        sales = rank_split(sales, order_by=order, skew=skew)
    return ranked_sales(sales, order, skew).drop(*[c for c in ORIGIN_COLUMNS if c in order])


def sales_with_products(
    tables: Tables,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    split_heavy: bool = False,
) -> DataFrame:
    """Ranked lines with the attributes of their product, for storing: ``enrich_further`` does the rest.

    The lines are moved once for the ranks (not if they come as ``ranked_lines``)
    and once for the products, so silver and quarantine need no join that moves
    them again.
    """
    sales = tables["sales_transactions"]
    ranked = sales if DUPLICATE_RANK in sales.columns else ranked_lines(sales, order_by, skew)
    return join_products(ranked, tables["products"], split_heavy)


#: The month that a line is stored by, as text.
MONTH_START = "_month_start"


def with_month_start(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add ``MONTH_START``: the month of the line's day if the calendar has it, else NULL.

    So there are no more months than the calendar has, whatever dates the lines come with.
    """
    months = calendar.select(F.trunc("date", "MM").cast("string").alias(MONTH_START)).distinct()
    month = F.trunc("transaction_date", "MM").cast("string")
    return lines.join(F.broadcast(months), month == months[MONTH_START], "left")


def checked_sales(
    tables: Tables,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Every enriched line with its ``quality_reason`` ("" = accepted)."""
    return add_quality_reason(enriched_sales(tables, order_by, skew, keys))


def _helper_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_")]


def to_silver(accepted: DataFrame) -> DataFrame:
    """Drop helper columns (``_``-prefixed, and the reason) and add realized measures."""
    drop = _helper_columns(accepted) + ([QUALITY_REASON] if QUALITY_REASON in accepted.columns else [])
    return add_realized_measures(accepted.drop(*drop))


def silver_schema(money: DataType) -> StructType:
    """Columns of the silver table, in its order, with the given type of money."""
    attributes = [
        f
        for schema, key in ((PRODUCT_SCHEMA, "product_id"), (STORE_SCHEMA, "store_id"), (CALENDAR_SCHEMA, "date"))
        for f in schema.fields
        if f.name != key
    ]
    joined = ["store_id", "product_id"]
    sales = [SALES_SCHEMA[c] for c in joined] + [f for f in SALES_SCHEMA.fields if f.name not in joined]
    realized = [StructField(c, RAW_MONEY) for c in ("realized_revenue", "realized_margin")]
    return StructType(
        [
            StructField(f.name, money if f.dataType == RAW_MONEY else f.dataType)
            for f in [*sales, *attributes, *realized]
        ]
    )


#: Directory levels of the silver table: calendar attributes of the line's day.
SILVER_PARTITIONS = ["year", "month"]


def write_silver(silver: DataFrame, path: str, dealt: bool = False) -> None:
    """Silver as Parquet, partitioned by year and month (``dealt``: its lines are dealt out by month already)."""
    write_parquet(silver, path, partition_by=SILVER_PARTITIONS, dealt=dealt)


def store_silver(silver: DataFrame, path: str) -> None:
    """``write_silver`` without moving the lines, which are the widest rows, for their months.

    They are stored by month where they lie, which takes a third of the bytes of a
    move, and gathered from there (see ``read_by_directory``).
    """
    spark = silver.sparkSession
    aside = scratch_uri(spark, "silver-by-month")
    try:
        write_silver(silver, aside, dealt=True)
        write_silver(read_by_directory(spark, aside, silver.schema, SILVER_PARTITIONS), path, dealt=True)
    finally:
        remove(spark, aside)


def read_silver(spark: SparkSession, path: str, money: DataType = RAW_MONEY) -> DataFrame:
    """The written silver lines in their own column order; filters on year and month prune directories.

    ``money`` is the type its money was written with. An empty table (no file
    to take columns from) reads as one without rows.
    """
    schema = silver_schema(money)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def silver_from_checked(checked: DataFrame) -> DataFrame:
    return to_silver(checked.where(F.col(QUALITY_REASON) == ""))


def quarantine_from_checked(checked: DataFrame) -> DataFrame:
    return rejected_only(checked)


def accepted_sales(tables: Tables, order_by: Sequence[str] | None = None, by_month: bool = False) -> DataFrame:
    """Silver through the explicit accept predicate (see module docstring).

    The plain rank window is kept on purpose: ``rank <= 1`` on it becomes
    a partial + final WindowGroupLimit, which keeps one line per id and
    map task before the shuffle, so a hot id costs nothing extra here.
    Lines that come ranked by such a window behave alike.
    """
    return to_silver(accepted_only(enriched_sales(tables, order_by, skew=None, by_month=by_month)))


def build_silver_sales(
    tables: Tables,
    order_by: Sequence[str] | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine) as two lazy frames over the same checked lines."""
    checked = checked_sales(tables, order_by, skew)
    return silver_from_checked(checked), quarantine_from_checked(checked)
