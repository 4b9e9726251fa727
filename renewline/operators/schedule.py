"""Spreading contract lines over their months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewline.functions.dates import add_months_keep_end, month_number
from renewline.functions.money import closing_amount, monthly_rate


def longest_term(lines: DataFrame) -> DataFrame:
    """One row: how many months the period numbers run to, at least 1."""
    return lines.agg(
        F.greatest(F.lit(1), F.coalesce(F.floor(F.max("term")), F.lit(1))).cast("int").alias("months")
    )


def period_numbers(lines: DataFrame) -> DataFrame:
    """The numbers 1 to the longest term, a fractional term rounded down."""
    return longest_term(lines).select(F.explode(F.sequence(F.lit(1), F.col("months"))).alias("period"))


def month_count(lines: DataFrame, truncated: bool = False) -> Column:
    """Months a line expands to; NULL or below 1 where it does not expand.

    Every month counts, the partial last one too, so the months of a line add up
    to its amount. ``truncated`` stops at the longest term of the table rounded
    down, as the literal definition does: that drops the partial last month of
    lines longer than that, and needs one more scan.
    """
    months = F.ceil("term").cast("int")
    if truncated:
        months = F.least(months, longest_term(lines).scalar())
    return F.when(F.col("term").isNotNull(), months)


def month_bounds(
    months: Column, start: Column, between: tuple | None = None
) -> tuple[Column, Column]:
    """First and last contract month to generate, as numbers counted from 1.

    ``between``, two dates as text or columns, keeps the months dated in the
    window. Adding months
    always lands in the wanted calendar month, so the bounds follow from the
    month difference and one comparison of days.
    """
    first, last = F.lit(1), months
    if between is not None:
        low, high = (F.to_date(F.lit(day)) if isinstance(day, str) else day for day in between)
        ahead = month_number(low) - month_number(start)
        first = F.greatest(
            first, ahead + 1 + (add_months_keep_end(start, ahead) < low).cast("int")
        )
        ahead = month_number(high) - month_number(start)
        until = ahead + 1 - (add_months_keep_end(start, ahead) > high).cast("int")
        # greatest and least skip NULLs, so a line without start or months needs care.
        last = F.when(start.isNotNull() & months.isNotNull(), F.least(months, until))
    return first, last


def with_month_bounds(
    df: DataFrame, months: Column, between: tuple | None = None
) -> DataFrame:
    """Add ``first_month`` and ``last_month``, computed once per row."""
    counted = df.withColumn("months", months)
    first, last = month_bounds(F.col("months"), F.col("startdate"), between)
    return counted.select("*", first.alias("first_month"), last.alias("last_month")).drop("months")


def month_list() -> Column:
    """Array of the month numbers within the bounds, NULL where there are none."""
    first, last = F.col("first_month"), F.col("last_month")
    return F.when((last >= 1) & (last >= first), F.sequence(first, last))


def with_amounts(lines: DataFrame) -> DataFrame:
    """Add ``rate`` and ``closing`` once per line, before it is spread.

    A line without a transaction has neither.
    """
    rated = lines.withColumn(
        "rate", F.when(F.col("tranid").isNotNull(), monthly_rate(F.col("amount"), F.col("term")))
    )
    return rated.withColumn(
        "closing", closing_amount(F.col("amount"), F.col("term"), F.col("rate"))
    )


def expand_term(
    lines: DataFrame, truncated: bool = False, between: tuple[str, str] | None = None
) -> DataFrame:
    """One row per contract month, with the unrounded monthly amount."""
    counted = with_month_bounds(lines, month_count(lines, truncated), between)
    once_per_line = counted.select(
        F.col("tranid").alias("id"),
        "customerid",
        "itemid",
        "term",
        "amount",
        "first_month",
        "last_month",
        F.try_divide(F.col("amount"), F.col("term")).alias("computed"),
        F.when(F.col("term") % 1 != 0, "Yes").otherwise("No").alias("ispartialterm"),
    )
    return once_per_line.select(
        "id",
        "customerid",
        "itemid",
        "term",
        "amount",
        F.explode(month_list()).alias("period"),
        "computed",
        "ispartialterm",
    )
