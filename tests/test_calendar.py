"""Calendar attributes."""

from __future__ import annotations

import datetime as dt

from salesmart.operators.calendar import build_calendar
from salesmart.schemas import CALENDAR_COLUMNS


def _by_day(spark, start, end):
    return {r["date"]: r for r in build_calendar(spark, start, end).collect()}


def test_spine_is_inclusive_and_ordered_columns(spark):
    cal = build_calendar(spark, "2024-02-27", "2024-03-02")
    assert cal.columns == CALENDAR_COLUMNS
    assert cal.count() == 5  # leap day included


def test_attributes(spark):
    days = _by_day(spark, "2020-12-28", "2021-01-08")
    d = days[dt.date(2021, 1, 3)]  # a Sunday in ISO week 53 of 2020
    assert (d["year"], d["quarter"], d["month"], d["week_of_year"]) == (2021, 1, 1, 53)
    assert d["month_name"] == "January" and d["day_of_week"] == "Sunday" and d["is_weekend"]
    assert d["holiday_name"] == "New Year slowdown" and d["season"] == "winter"
    assert days[dt.date(2021, 1, 8)]["holiday_name"] is None
    assert days[dt.date(2020, 12, 28)]["holiday_name"] is None
    assert not days[dt.date(2021, 1, 8)]["is_weekend"]


def test_holidays_and_seasons(spark):
    days = _by_day(spark, "2025-11-20", "2025-12-31")
    assert days[dt.date(2025, 11, 28)]["holiday_name"] == "Black Friday"  # Friday 28th
    assert days[dt.date(2025, 11, 21)]["holiday_name"] is None  # a Friday before the 23rd
    assert days[dt.date(2025, 11, 27)]["holiday_name"] is None  # Thursday
    assert days[dt.date(2025, 12, 10)]["holiday_name"] == "Holiday shopping"
    assert days[dt.date(2025, 12, 24)]["holiday_name"] == "Holiday shopping"
    assert days[dt.date(2025, 12, 25)]["holiday_name"] is None
    assert days[dt.date(2025, 11, 30)]["season"] == "autumn"
    assert days[dt.date(2025, 12, 1)]["season"] == "winter"
    seasons = {r["month"]: r["season"] for r in build_calendar(spark, "2025-01-01", "2025-12-31").collect()}
    assert seasons == {1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer",
                       7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn", 12: "winter"}
