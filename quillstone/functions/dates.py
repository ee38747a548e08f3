"""Month arithmetic and bands of time. A month is an integer YYYYMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yyyymm(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def month_index(month: Column) -> Column:
    """Months since year 0 of a YYYYMM."""
    return F.floor(month / 100).cast("int") * 12 + month % 100 - 1


def month_from_index(index: Column) -> Column:
    return (F.floor(index / 12) * 100 + F.pmod(index, F.lit(12)) + 1).cast("int")


def add_months(month: Column, n: Column | int) -> Column:
    return month_from_index(month_index(month) + n)


def previous_month(month: Column) -> Column:
    return add_months(month, -1)


def whole_months(later: Column, earlier: Column) -> Column:
    """Months between two dates by their calendar months alone; days don't count."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def months_since(month: Column, date: Column) -> Column:
    """Months from a date's month to a YYYYMM."""
    return month_index(month) - (F.year(date) * 12 + F.month(date) - 1)


def iso_date(text: Column) -> Column:
    """Date of an ISO text; null for all else, years alone included."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def uk_date(text: Column) -> Column:
    """Date of a day/month/year text, with or without leading zeros; null for a bad one."""
    return F.try_to_date(F.trim(text), "d/M/yyyy")


def age_band_days(days: Column) -> Column:
    # Thresholds of two, five and ten years in days.
    return F.when(days.isNull(), "UNKNOWN").when(days < 730, "<2y").when(days < 1826, "2-5y").when(days < 3653, "5-10y").otherwise("10y+")


def age_band_months(months: Column) -> Column:
    return F.when(months < 24, "0-23").when(months < 60, "24-59").when(months < 120, "60-119").when(months < 240, "120-239").when(months >= 240, "240+")
