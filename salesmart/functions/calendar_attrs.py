"""Calendar attribute expressions on a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season names by month, holiday labels and their day
# windows. They must equal the source data's labels.
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)
SEASON_WINTER, SEASON_SPRING, SEASON_SUMMER, SEASON_AUTUMN = "winter", "spring", "summer", "autumn"
BLACK_FRIDAY = "Black Friday"  # a Friday, November 23..29
HOLIDAY_SHOPPING = "Holiday shopping"  # December 10..24
NEW_YEAR_SLOWDOWN = "New Year slowdown"  # January 1..7

_FRIDAY = 4  # Spark weekday(): Monday = 0


def season(month: Column) -> Column:
    return (
        F.when(month.isin(*WINTER_MONTHS), F.lit(SEASON_WINTER))
        .when(month.isin(*SPRING_MONTHS), F.lit(SEASON_SPRING))
        .when(month.isin(*SUMMER_MONTHS), F.lit(SEASON_SUMMER))
        .otherwise(F.lit(SEASON_AUTUMN))
    )


def holiday_name(day: Column) -> Column:
    """First matching label wins; NULL when none applies.

    The source writes "" for no holiday, which its CSV reader returns as
    NULL; the dimension built here carries that NULL directly.
    """
    month, dom = F.month(day), F.dayofmonth(day)
    return (
        F.when(
            (month == 11) & (F.weekday(day) == _FRIDAY) & dom.between(23, 29),
            F.lit(BLACK_FRIDAY),
        )
        .when((month == 12) & dom.between(10, 24), F.lit(HOLIDAY_SHOPPING))
        .when((month == 1) & (dom <= 7), F.lit(NEW_YEAR_SLOWDOWN))
    )


def calendar_attributes(day: Column) -> list[Column]:
    """The nine attribute columns of the calendar dimension, in order."""
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),  # ISO-8601 week
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        holiday_name(day).alias("holiday_name"),
        season(F.month(day)).alias("season"),
    ]
