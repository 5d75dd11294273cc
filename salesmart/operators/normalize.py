"""Canonical text and derived line measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.money import money, zero_of

SOURCE_ROW_ID = "_source_row_id"
PAID = "paid"
CANCELLED = "cancelled"


def add_source_row_id(df: DataFrame) -> DataFrame:
    """Ingest-order id: ascending inside a split of a file.

    Computed once at ingest and persisted with the bronze table, so later
    re-evaluations cannot change which copy of a transaction is first. Over
    several files the order is (file, split start, this id): Spark packs
    splits into tasks by size, so the id alone says nothing across splits.
    """
    return df.withColumn(SOURCE_ROW_ID, F.monotonically_increasing_id())


def canonical_code(col: Column) -> Column:
    """lower(trim(x)): trim removes ASCII spaces only (a tab stays)."""
    return F.lower(F.trim(col))


def canonical_key(col: Column) -> Column:
    return F.trim(col)


def normalize_sales(sales: DataFrame) -> DataFrame:
    """Channel and status lower-cased and trimmed; product and store ids trimmed.

    Transaction and order ids are left exactly as read.
    """
    return sales.withColumns(
        {
            "channel": canonical_code(F.col("channel")),
            "order_status": canonical_code(F.col("order_status")),
            "product_id": canonical_key(F.col("product_id")),
            "store_id": canonical_key(F.col("store_id")),
        }
    )


def add_realized_measures(df: DataFrame) -> DataFrame:
    """realized_* = the measure for paid lines, else zero (also for NULL status)."""
    paid = F.col("order_status") == PAID
    return df.withColumns(
        {
            "realized_revenue": F.when(paid, F.col("net_revenue")).otherwise(zero_of(df, "net_revenue")),
            "realized_margin": F.when(paid, F.col("margin")).otherwise(zero_of(df, "margin")),
        }
    )


def line_measures(
    quantity: Column,
    unit_price: Column,
    discount_percent: Column,
    unit_cost: Column,
    order_status: Column,
) -> list[Column]:
    """gross, net, total cost and margin of a line, each rounded to cents.

    gross = round(q * price); net = round(gross * (1 - disc / 100));
    cost = round(q * unit_cost); margin = round(net - cost). Cancelled
    lines keep gross and cost but get net and margin 0. ``(100 - disc) *
    0.01`` keeps the arithmetic exact in DECIMAL.
    """
    price, disc, ucost = money(unit_price), money(discount_percent), money(unit_cost)
    gross = money(F.round(quantity * price, 2))
    net = money(F.round(gross * (F.lit(100) - disc) * F.lit("0.01").cast("decimal(3,2)"), 2))
    cost = money(F.round(quantity * ucost, 2))
    margin = money(F.round(net - cost, 2))
    cancelled = F.lower(F.trim(order_status)) == CANCELLED
    zero = money(F.lit(0))
    return [
        gross.alias("gross_revenue"),
        F.when(cancelled, zero).otherwise(net).alias("net_revenue"),
        cost.alias("total_cost"),
        F.when(cancelled, zero).otherwise(margin).alias("margin"),
    ]
