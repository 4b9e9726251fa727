"""Display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def person_name(first: Column, last: Column) -> Column:
    """First and last name around one space; a missing part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def customer_name(isperson: Column, company: Column, first: Column, last: Column) -> Column:
    """Company name for companies, the person's name for everybody else."""
    return F.when(isperson == "F", company).otherwise(person_name(first, last))
