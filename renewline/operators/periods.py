"""Accounting periods and the period a date posts to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly_periods(periods: DataFrame) -> DataFrame:
    """Month periods: those that are neither a quarter nor a year."""
    return periods.where((F.col("isquarter") == "F") & (F.col("isyear") == "F")).select(
        F.col("id").alias("periodid"), "periodname", "startdate", "enddate"
    )


def period_calendar(months: DataFrame) -> DataFrame:
    """One row per period and calendar month it touches.

    A month period that follows the calendar gives one row. The month turns the
    date-in-range join into a hash join with the range as a residual condition.
    """
    return (
        months.where(F.col("startdate") <= F.col("enddate"))
        .select(
            F.explode(
                F.sequence(F.trunc("startdate", "MM"), F.col("enddate"), F.expr("interval 1 month"))
            ).alias("cal_month"),
            F.col("startdate").alias("periodstart"),
            F.col("enddate").alias("periodend"),
            F.col("periodid").alias("postingperiodid"),
            F.col("periodname").alias("postingperiod"),
        )
    )


def posting_period(df: DataFrame, day: Column, months: DataFrame, how: str = "left") -> DataFrame:
    """Add ``postingperiodid, postingperiod, periodstart`` of the period holding ``day``.

    Overlapping periods give one row each. The calendar carries no broadcast
    hint: Catalyst broadcasts it while it is below autoBroadcastJoinThreshold
    and otherwise shuffles on the month, where AQE splits skewed months.
    """
    dated = df.withColumn("cal_day", day)
    calendar = period_calendar(months)
    cal_day = F.col("cal_day")
    held = (F.trunc(cal_day, "MM") == F.col("cal_month")) & cal_day.between(
        F.col("periodstart"), F.col("periodend")
    )
    return dated.join(calendar, held, how).drop("cal_day", "cal_month", "periodend")


def overlapping_periods(months: DataFrame) -> DataFrame:
    """Month periods that share a day with an earlier one.

    Two overlapping periods meet in at least one calendar month, so comparing
    each period with the latest end seen before it inside every month finds
    them without pairing the table with itself.
    """
    earlier = (
        Window.partitionBy("cal_month")
        .orderBy("periodstart", "postingperiodid")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        period_calendar(months)
        .withColumn("latest_end", F.max("periodend").over(earlier))
        .where(F.col("periodstart") <= F.col("latest_end"))
        .select(
            F.col("postingperiodid").alias("periodid"),
            F.col("postingperiod").alias("periodname"),
            F.col("periodstart").alias("startdate"),
            F.col("periodend").alias("enddate"),
        )
        .distinct()
    )
