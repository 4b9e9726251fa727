"""Keeping one huge key out of a single window task.

A window needs all rows of its key in one task. Keys that are too big for that
are found first, so they can be computed another way while everything else
keeps the plain one-exchange plan. Both ways give the same rows, so the search
only picks a plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is big when it holds more rows than HOT_ROWS and more than one
# HOT_SHARE-th of the table. So there are never more than HOT_SHARE big keys,
# whatever the size of the table: that bounds what is collected.
HOT_ROWS = 250_000
HOT_SHARE = 10_000
# A few buckets per big key there can be: enough that most hold no big one.
HASH_BUCKETS = 4 * HOT_SHARE


def null_safe_match(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Equality on several columns, NULL matching NULL as it does in a window."""
    return reduce(
        lambda a, b: a & b,
        [left[name].eqNullSafe(right[other]) for name, other in pairs.items()],
    )


def hot_keys(
    df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, hot_share: int = HOT_SHARE
) -> DataFrame | None:
    """The keys too big for one task, or None. Runs one or two small counting jobs.

    Counting every key would shuffle nearly the whole key column of a table
    with many small keys. Counting hash buckets shuffles at most HASH_BUCKETS
    counters per task, and a key can only be big if its bucket is; exact counts
    are then needed for the keys of big buckets alone. The rows of the table are
    the sum of the buckets.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS))
    counted = df.groupBy(bucket.alias("bucket")).count()
    # At most HASH_BUCKETS rows, and only those that can hold a big key come back.
    total = F.sum("count")
    top = counted.agg(
        total.alias("rows"),
        F.collect_list(F.when(F.col("count") > hot_rows, F.struct("bucket", "count"))).alias("big"),
    ).first()
    limit = max(hot_rows, -(-(top["rows"] or 0) // hot_share))
    buckets = [b["bucket"] for b in top["big"] if b["count"] > limit]
    if not buckets:
        return None
    found = (
        df.where(bucket.isin(buckets))
        .groupBy(*keys)
        .count()
        .where(F.col("count") > limit)
        .select(*keys)
    )
    big = found.collect()
    # Catalyst does not know the size of rows that the driver hands over, so it is told that they are few: a shuffled
    # join would bring a big key into one task again.
    return F.broadcast(df.sparkSession.createDataFrame(big, found.schema)) if big else None


def split_by_keys(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows outside and inside the ``hot`` keys.

    Detected keys are few and broadcast. A caller may name any number: beyond
    the broadcast threshold the join shuffles.
    """
    listed = hot.select(*[F.col(k).alias(f"hot_{k}") for k in keys])
    match = null_safe_match(df, listed, {k: f"hot_{k}" for k in keys})
    return df.join(listed, match, "left_anti"), df.join(listed, match, "left_semi")
