"""Checks of the input, and repair of dangling references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_tranids(lines: DataFrame) -> DataFrame:
    """Transactions with more than one contract line, and how many they have.

    The reports assume one line per transaction.
    """
    counted = lines.where(F.col("tranid").isNotNull()).groupBy("tranid").agg(F.count("*").alias("lines"))
    return counted.where(F.col("lines") > 1)


def duplicate_lines(lines: DataFrame) -> DataFrame:
    """Line ids that occur more than once, and how often. The import gives each id once."""
    return lines.groupBy("line_id").agg(F.count("*").alias("lines")).where(F.col("lines") > 1)


def split_required(lines: DataFrame, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required fields, and the others with the missing names."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    checked = lines.withColumn("missing", missing if required else F.array().cast("array<string>"))
    return (
        checked.where(F.size("missing") == 0).drop("missing"),
        checked.where(F.size("missing") > 0),
    )


def null_dangling(
    lines: DataFrame, transactions: DataFrame, customers: DataFrame, items: DataFrame
) -> DataFrame:
    """Set references to NULL whose parent is gone. ``id`` is the parents' key.

    A parent id that repeats is one parent: no line is added.
    """
    parents = {"tranid": transactions, "customerid": customers, "itemid": items}

    def checked(rows: DataFrame, key: str) -> DataFrame:
        ids = parents[key].select(F.col("id").alias("parent_id")).distinct()
        found = rows.join(ids, rows[key] == ids["parent_id"], "left")
        return found.withColumn(key, F.col("parent_id")).drop("parent_id")

    return reduce(checked, parents, lines).select(*lines.columns)
