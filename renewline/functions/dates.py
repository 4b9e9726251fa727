"""Month arithmetic with the month-end rule of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months_keep_end(day: Column, months: Column) -> Column:
    """Add months; the last day of a month always maps to the last day."""
    moved = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def month_number(day: Column) -> Column:
    """Months counted from year 0, for differences between calendar months."""
    return F.year(day) * 12 + F.month(day)
