"""Calendar dimension (G1-G3): a date spine with its attributes.

The spine is ``explode(sequence(start, end))`` over a one-row bounds frame,
so the range can come from literals or from an aggregate of the data. Its
size is the number of days in the range (bounded by the calendar span, not
by the fact volume).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.calendar_attrs import calendar_attributes
from salesmart.schemas import CALENDAR_COLUMNS


def calendar_from_bounds(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Calendar rows for every day from ``start`` to ``end`` inclusive.

    ``bounds`` holds one row with two DATE columns.
    """
    spine = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return spine.select(F.col("date"), *calendar_attributes(F.col("date"))).select(*CALENDAR_COLUMNS)


def build_calendar(
    spark: SparkSession, start: str | _dt.date, end: str | _dt.date
) -> DataFrame:
    """Calendar for a literal range, e.g. ``build_calendar(spark, "2025-01-01", "2026-06-30")``."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start"), F.lit(str(end)).cast("date").alias("end")
    )
    return calendar_from_bounds(bounds)
