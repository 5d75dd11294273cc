"""Seasonal and channel-mix analyses of the paid silver lines.

Each is one grouped count followed by a share inside its frame. The
share's window runs over the already aggregated rows (a few per month or
category), never over the lines themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.plans.gold import paid_lines

# The late-November event window starts on this day.
EVENT_MONTH = 11
EVENT_FIRST_DAY = 23


def _share(counts: DataFrame, frame: Sequence[str], count_col: str = "line_count") -> Column:
    total = F.sum(count_col).over(Window.partitionBy(*frame))
    return (F.col(count_col).cast("double") / total.cast("double")).alias("share")


def category_share_event_window(silver: DataFrame) -> DataFrame:
    """Category share of paid lines inside vs outside the late-November window."""
    in_window = (F.month("transaction_date") == EVENT_MONTH) & (
        F.dayofmonth("transaction_date") >= EVENT_FIRST_DAY
    )
    counts = (
        paid_lines(silver)
        .groupBy(in_window.alias("in_event_window"), "category")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    return counts.select("in_event_window", "category", "line_count", _share(counts, ["in_event_window"]))


def weekend_effect(silver: DataFrame) -> DataFrame:
    """Per weekend flag and category: lines, share, and lines per calendar day."""
    daily = (
        paid_lines(silver)
        .groupBy("is_weekend", "transaction_date", "category")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    flag = Window.partitionBy("is_weekend")
    counts = (
        daily.groupBy("is_weekend", "category")
        .agg(F.sum("line_count").alias("line_count"), F.collect_set("transaction_date").alias("_days"))
        .withColumn("day_count", F.size(F.array_distinct(F.flatten(F.collect_list("_days").over(flag)))).cast("long"))
        .drop("_days")
    )
    return counts.select(
        "is_weekend",
        "category",
        "line_count",
        "day_count",
        (F.col("line_count").cast("double") / F.col("day_count").cast("double")).alias("lines_per_day"),
        _share(counts, ["is_weekend"]),
    )


def channel_share_monthly(silver: DataFrame) -> DataFrame:
    """Channel share of paid lines per calendar month."""
    counts = (
        paid_lines(silver)
        .groupBy("year", "month", "channel")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    return counts.select("year", "month", "channel", "line_count", _share(counts, ["year", "month"]))


def category_share_monthly(silver: DataFrame) -> DataFrame:
    """Category share of paid lines per calendar month, with the month's season."""
    counts = (
        paid_lines(silver)
        .groupBy("year", "month", "season", "category")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    return counts.select(
        "year", "month", "season", "category", "line_count", _share(counts, ["year", "month"])
    )


def category_share_season(silver: DataFrame) -> DataFrame:
    """Category share of paid lines per season."""
    counts = paid_lines(silver).groupBy("season", "category").agg(F.count(F.lit(1)).alias("line_count"))
    return counts.select("season", "category", "line_count", _share(counts, ["season"]))
