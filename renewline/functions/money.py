"""Exact money arithmetic.

Amounts are ``decimal(18,2)`` and terms ``decimal(12,6)``, so Spark keeps 15
digits of the quotient. A quotient that is not exactly half a cent is at least
1/(2 * 10^12) cents away from it, which is wider than that last digit, so
rounding the quotient to cents never rounds twice.

A rate can be a million times the amount, for the smallest term. Rates and what
is left after whole months are therefore wider than amounts; a month that does
not fit an amount is NULL in the reports, for its own line alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TERM = "decimal(12,6)"
WIDE = "decimal(24,2)"


def monthly_rate(amount: Column, term: Column) -> Column:
    """Amount per month, rounded half away from zero; NULL for a zero term."""
    return F.round(F.try_divide(amount, term), 2).cast(WIDE)


def closing_amount(amount: Column, term: Column, rate: Column) -> Column:
    """What is left of ``amount`` after every whole month was paid at ``rate``."""
    return (amount - term.cast("int") * rate).try_cast(WIDE)


def month_amount(period: Column, term: Column, rate: Column, closing: Column) -> Column:
    """Revenue of one contract month.

    The partial month after the last whole one gets the remainder. Where the
    term is whole, the last month takes the remainder on top of its own rate,
    so the months of a contract add up to its amount.
    """
    return (
        F.when(period > term, closing)
        .when(period == term, closing + rate)
        .when(period.isNotNull(), rate)
    )


def shown(amount: Column) -> Column:
    """An amount as reports show it; NULL where it does not fit."""
    return amount.try_cast(MONEY)
