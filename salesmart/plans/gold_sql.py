"""Gold rollups through Spark SQL over a view of the silver lines.

Same results as ``salesmart.plans.gold`` for DECIMAL and for DOUBLE silver
(tested): both take their money expressions from ``functions.money``. For users
who query the accepted lines in SQL; ``register_silver`` gives the view a name of
their choice, and the gold queries here use a name of their own for each call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesmart.functions.money import is_exact, mean_sql, sum_sql
from salesmart.plans.gold import OVERVIEW, ROLLUP_KEYS

SILVER_VIEW = "silver_sales"


def register_silver(silver: DataFrame, name: str = SILVER_VIEW) -> str:
    silver.createOrReplaceTempView(name)
    return name


def overview_sql(view: str = SILVER_VIEW, exact: bool = True) -> str:
    """The daily overview; ``exact``: the silver money is DECIMAL (else DOUBLE)."""
    if exact:
        revenue = "CAST(ROUND(SUM(realized_revenue) * 100, 0) AS BIGINT)"
        average = (
            "CASE WHEN order_count = 0 THEN CAST(0 AS DOUBLE) "
            "ELSE CAST((2 * revenue + order_count) div (2 * order_count) AS DOUBLE) / 100 END"
        )
    else:
        revenue, average = mean_sql("realized_revenue", "COUNT(DISTINCT order_id)"), "revenue"
    return f"""
    SELECT transaction_date, order_count, order_line_count, units_sold, net_revenue,
           gross_revenue, total_cost, margin, {average} AS average_order_value
    FROM (
      SELECT transaction_date,
             COUNT(DISTINCT order_id) AS order_count,
             COUNT(*) AS order_line_count,
             CAST(SUM(quantity) AS BIGINT) AS units_sold,
             {sum_sql("realized_revenue", exact)} AS net_revenue,
             {sum_sql("gross_revenue", exact)} AS gross_revenue,
             {sum_sql("total_cost", exact)} AS total_cost,
             {sum_sql("realized_margin", exact)} AS margin,
             {revenue} AS revenue
      FROM {view}
      WHERE order_status = 'paid'
      GROUP BY transaction_date
    ) daily
    """


def rollup_sql(keys: list[str], view: str = SILVER_VIEW, exact: bool = True) -> str:
    group = ", ".join(["transaction_date", *keys])
    return f"""
    SELECT {group},
           COUNT(*) AS order_line_count,
           CAST(SUM(quantity) AS BIGINT) AS units_sold,
           {sum_sql("realized_revenue", exact)} AS net_revenue,
           {sum_sql("realized_margin", exact)} AS margin
    FROM {view}
    WHERE order_status = 'paid'
    GROUP BY {group}
    """


def gold_table_sql(spark: SparkSession, silver: DataFrame, name: str, view: str | None = None) -> DataFrame:
    """One gold table by SQL text over the silver lines registered as ``view`` (default: a fresh name)."""
    view = register_silver(silver, view or f"{SILVER_VIEW}_{uuid.uuid4().hex[:12]}")
    exact = is_exact(silver, "realized_revenue")
    text = overview_sql(view, exact) if name == OVERVIEW else rollup_sql(ROLLUP_KEYS[name], view, exact)
    return spark.sql(text)


def build_gold_tables_sql(spark: SparkSession, silver: DataFrame) -> dict[str, DataFrame]:
    return {name: gold_table_sql(spark, silver, name) for name in [OVERVIEW, *ROLLUP_KEYS]}
