"""Churn rows, and the union of contracts and churns.

A churn row is made from the line that ends, so contracts and churns come out
of one pass over the ordered lines instead of two passes and a union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewline.functions.money import MONEY, shown
from renewline.operators.periods import posting_period
from renewline.operators.schedule import with_amounts


def has_churn() -> Column:
    """No contract follows, or the next one starts more than a day later."""
    return F.col("gapwithnext").isNull() | (F.col("gapwithnext") > 1)


def churn_day() -> Column:
    return F.date_add("enddate", 1)


def churns(typed: DataFrame) -> DataFrame:
    """Churn rows, dated the day after the end."""
    return typed.where(has_churn()).select(
        "customerid",
        "itemid",
        churn_day().alias("startdate"),
        churn_day().alias("enddate"),
        F.lit("Churn").alias("ordertype"),
    )


def churns_mrr(typed: DataFrame, months: DataFrame) -> DataFrame:
    """Churn rows with the ended transaction, its monthly rate and the period."""
    dated = with_amounts(typed.where(has_churn()))
    return posting_period(dated, churn_day(), months).select(
        F.col("tranid").alias("previoustranid"),
        "customerid",
        "itemid",
        churn_day().alias("startdate"),
        churn_day().alias("enddate"),
        F.lit("Churn").alias("ordertype"),
        "postingperiod",
        "postingperiodid",
        shown(F.col("rate")).alias("computed"),
    )


def with_churn_rows(typed: DataFrame) -> DataFrame:
    """Each line as it is (``churned`` false), and once more if it churns."""
    both = F.array(F.lit(False), F.lit(True))
    return typed.withColumn(
        "churned", F.explode(F.when(has_churn(), both).otherwise(F.array(F.lit(False))))
    )


def lifecycle_columns(previous_of_churn: Column) -> list[Column]:
    """Columns of the union, read from ``with_churn_rows``."""
    churned = F.col("churned")
    return [
        F.when(~churned, F.col("tranid")).alias("tranid"),
        F.col("customerid"),
        F.col("itemid"),
        F.when(churned, churn_day()).otherwise(F.col("startdate")).alias("startdate"),
        F.when(churned, churn_day()).otherwise(F.col("enddate")).alias("enddate"),
        F.when(churned, "Churn").otherwise(F.col("ordertype")).alias("ordertype"),
        F.when(churned, previous_of_churn).otherwise(F.col("previoustranid")).alias("previoustranid"),
    ]


def lifecycle_union(typed: DataFrame) -> DataFrame:
    """Contracts and churns; churns name no transaction and no previous one."""
    return with_churn_rows(typed).select(*lifecycle_columns(F.lit(None).cast("long")))


def lifecycle_union_mrr(typed: DataFrame, months: DataFrame) -> DataFrame:
    """Contracts and churns; churns carry the ended transaction, period and rate."""
    rows = with_churn_rows(with_amounts(typed))
    posted = posting_period(rows, F.when(F.col("churned"), churn_day()), months)
    return posted.select(
        *lifecycle_columns(F.col("tranid")),
        "postingperiod",
        "postingperiodid",
        F.when(F.col("churned"), shown(F.col("rate"))).otherwise(F.lit(0).cast(MONEY)).alias("computed"),
    )
