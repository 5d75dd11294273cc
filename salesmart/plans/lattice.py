"""Gold from two mergeable base aggregates.

The paid silver lines are reduced once to the finest grain that the four
rollups share (day, product attributes, city, region, channel) and once to (day,
order), which exact order counts need. Both hold lines, units or money sums
that add up, so both are stored and mergeable: equal grains of several batches
add up, equal orders unite. All five gold tables are re-aggregates of these two
tables. The lines are scanned twice whatever the number of tables, and a late
batch of lines only adds its own partials: the tables are then finished anew
from the partials, never from the lines.

Money sums are stored as mergeable state (see ``functions.money``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.money import (
    cents,
    half_up_ratio,
    has_limb_state,
    money_state,
    state_columns,
    state_mean,
    state_merge,
    state_sum,
)
from salesmart.plans.actions import concurrently
from salesmart.plans.gold import GOLD_TABLES, OVERVIEW, ROLLUP_KEYS, paid_lines
from salesmart.sources.files import write_parquet
from salesmart.sources.layout import Layout

DAY = "transaction_date"
BASE_GRAIN = [DAY, "product_id", "product_name", "category", "city", "region", "channel"]
BASE_MEASURES = ["realized_revenue", "realized_margin"]
ORDER_GRAIN = [DAY, "order_id"]
ORDER_MEASURES = ["gross_revenue", "total_cost"]
#: Directory level of the stored partials: one directory for each batch of lines.
BATCH = "batch"


def base_partials(silver: DataFrame) -> DataFrame:
    """Lines, units and realized money of the paid lines by ``BASE_GRAIN``."""
    return paid_lines(silver).groupBy(*BASE_GRAIN).agg(
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum("quantity").cast("long").alias("units_sold"),
        *[c for m in BASE_MEASURES for c in money_state(silver, m)],
    )


def order_partials(silver: DataFrame) -> DataFrame:
    """Gross and cost of the paid lines by (day, order); lines without an order id are one group of a day."""
    states = [c for m in ORDER_MEASURES for c in money_state(silver, m)]
    return paid_lines(silver).groupBy(*ORDER_GRAIN).agg(*states)


def _merged_base(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.groupBy(*keys).agg(
        F.sum("order_line_count").alias("order_line_count"),
        F.sum("units_sold").alias("units_sold"),
        *[c for m in BASE_MEASURES for c in state_merge(base, m)],
    )


def _merged_orders(orders: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    return orders.groupBy(*keys).agg(*counts, *[c for m in ORDER_MEASURES for c in state_merge(orders, m)])


def merge_base(parts: Sequence[DataFrame]) -> DataFrame:
    """One base aggregate of several batches' (equal grains add up)."""
    return _merged_base(reduce(DataFrame.unionByName, parts), BASE_GRAIN)


def merge_orders(parts: Sequence[DataFrame]) -> DataFrame:
    """One table of (day, order) partials of several batches'."""
    return _merged_orders(reduce(DataFrame.unionByName, parts), ORDER_GRAIN)


def rollup_from(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A daily rollup by ``keys`` from base partials (of one or several batches)."""
    return _merged_base(base, [DAY, *keys]).select(
        DAY,
        *keys,
        "order_line_count",
        "units_sold",
        state_sum(base, "realized_revenue").alias("net_revenue"),
        state_sum(base, "realized_margin").alias("margin"),
    )


def overview_from(base: DataFrame, orders: DataFrame) -> DataFrame:
    """The daily overview from base and order partials (of one or several batches)."""
    lines = _merged_base(base, [DAY])
    # an order of several batches is one group before it is counted
    days = _merged_orders(merge_orders([orders]), [DAY], F.count("order_id").alias("order_count"))
    ready = lines.join(days.withColumnRenamed(DAY, "_day"), F.col(DAY).eqNullSafe(F.col("_day")))
    if has_limb_state(base, "realized_revenue"):
        average = state_mean("realized_revenue", "order_count")
    else:  # DECIMAL money is divided in integer cents, as in ``plans.gold``
        ready = ready.withColumn("_cents", cents(state_columns("realized_revenue").total))
        average = half_up_ratio("_cents", "order_count")
    return ready.select(
        DAY,
        "order_count",
        "order_line_count",
        "units_sold",
        state_sum(base, "realized_revenue").alias("net_revenue"),
        state_sum(orders, "gross_revenue").alias("gross_revenue"),
        state_sum(orders, "total_cost").alias("total_cost"),
        state_sum(base, "realized_margin").alias("margin"),
        average.alias("average_order_value"),
    )


def gold_from(base: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    """The five gold tables from base and order partials."""
    return {
        name: overview_from(base, orders) if name == OVERVIEW else rollup_from(base, ROLLUP_KEYS[name])
        for name in GOLD_TABLES
    }


# --- stored partials


def write_partials(silver: DataFrame, root: str, batch: str) -> None:
    """Store the partials of a batch of silver lines as ``<root>/<table>/batch=<batch>``."""
    concurrently(
        lambda: write_parquet(base_partials(silver), f"{root}/base/{BATCH}={batch}"),
        lambda: write_parquet(order_partials(silver), f"{root}/orders/{BATCH}={batch}"),
    )


def read_partials(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(base partials, order partials) of every stored batch."""
    return (
        spark.read.parquet(f"{root}/base").drop(BATCH),
        spark.read.parquet(f"{root}/orders").drop(BATCH),
    )


def write_gold(spark: SparkSession, partials_root: str, gold_root: str) -> None:
    """Finish the five gold tables from the stored partials of all batches."""
    tables = gold_from(*read_partials(spark, partials_root))
    concurrently(
        *[(lambda n=name, df=df: write_parquet(df, f"{gold_root}/{n}")) for name, df in tables.items()]
    )


def add_late_lines(spark: SparkSession, layout: Layout, silver_lines: DataFrame, batch: str) -> None:
    """Take a late batch of accepted silver lines into the gold tables.

    Only these lines are read; a batch of the same name is replaced, so a
    repeated call changes nothing.
    """
    write_partials(silver_lines, layout.partials_dir, batch)
    write_gold(spark, layout.partials_dir, layout.gold_dir)
