"""Daily gold rollups of the paid silver lines.

All five group by day over ``order_status = 'paid'`` lines. Aggregation
is partial (map-side) + final, so a hot day or product is combined before
the shuffle. Money sums are exact and cast to DOUBLE last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.money import cents, half_up_ratio, is_exact, rounded_mean, rounded_sum
from salesmart.operators.normalize import PAID

# Gold table names and their group keys after the day.
ROLLUP_KEYS: dict[str, list[str]] = {
    "sales_by_product_daily": ["product_id", "product_name", "category"],
    "sales_by_category_daily": ["category"],
    "sales_by_city_daily": ["city", "region"],
    "sales_by_channel_daily": ["channel"],
}
OVERVIEW = "metric_overview_daily"
GOLD_TABLES = [OVERVIEW, *ROLLUP_KEYS]


def paid_lines(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("order_status") == PAID)


def metric_overview_daily(silver: DataFrame) -> DataFrame:
    """Orders, lines, units and money per day; average order value half-up.

    With DECIMAL money the average is divided in integer cents (exact); with
    DOUBLE money it is the rounded quotient of the exact sum, and NaN stays
    NaN.
    """
    paid = paid_lines(silver)
    orders = F.count_distinct("order_id")
    if is_exact(silver, "realized_revenue"):
        average_of = cents(F.sum("realized_revenue")).alias("_revenue")
        average = half_up_ratio("_revenue", "order_count")
    else:
        average_of = rounded_mean(silver, "realized_revenue", orders).alias("_average")
        average = F.col("_average")
    agg = paid.groupBy("transaction_date").agg(
        orders.alias("order_count"),
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum("quantity").cast("long").alias("units_sold"),
        rounded_sum(silver, "realized_revenue").alias("net_revenue"),
        rounded_sum(silver, "gross_revenue").alias("gross_revenue"),
        rounded_sum(silver, "total_cost").alias("total_cost"),
        rounded_sum(silver, "realized_margin").alias("margin"),
        average_of,
    )
    return agg.select(
        "transaction_date",
        "order_count",
        "order_line_count",
        "units_sold",
        "net_revenue",
        "gross_revenue",
        "total_cost",
        "margin",
        average.cast("double").alias("average_order_value"),
    )


def daily_rollup(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines, units, net revenue and margin per day and ``keys``."""
    return paid_lines(silver).groupBy("transaction_date", *keys).agg(
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum("quantity").cast("long").alias("units_sold"),
        rounded_sum(silver, "realized_revenue").alias("net_revenue"),
        rounded_sum(silver, "realized_margin").alias("margin"),
    )


def gold_table(silver: DataFrame, name: str) -> DataFrame:
    if name == OVERVIEW:
        return metric_overview_daily(silver)
    return daily_rollup(silver, ROLLUP_KEYS[name])


def build_gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: gold_table(silver, name) for name in GOLD_TABLES}
