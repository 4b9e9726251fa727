"""Order of the contracts of one customer and item.

Rows are ordered by end date (missing last), then start date, transaction and
line, and by all other columns where even those are equal; rows equal in every
column follow each other. Ordinary timelines are computed by windows after a
single exchange on (customer, item). A timeline too big for one task is first
reduced to its distinct pairs of dates, so what a task sorts does not grow with
the lines. Both ways give the same rows, repeated ones included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewline.operators.skew import hot_keys, null_safe_match, split_by_keys

KEY = ["customerid", "itemid"]
PREVIOUS = ["previousenddate", "previoustranid"]
GAPS = ["gapwithprevious", "gapwithnext"]

ORDER = ["enddate", "startdate", "tranid", "line_id"]

_NO_TRANSACTION = -(2**63)


def hot_timelines(lines: DataFrame, **limits: int) -> DataFrame | None:
    """Timelines that hold too many lines for one task, or None."""
    return hot_keys(lines, KEY, **limits)


# Previous contract -----------------------------------------------------------


def _usable_end() -> Column:
    """A line whose end another line of the same timeline may follow."""
    return F.col("enddate").isNotNull() & F.col("customerid").isNotNull() & F.col("itemid").isNotNull()


def _after_latest_end(events: DataFrame) -> DataFrame:
    """Start events with the previous contract: the last end before their ``day``.

    On one day starts sort before ends, so a contract ending on the very start
    day is not seen; among the ends of a day the highest transaction is last.
    """
    so_far = (
        Window.partitionBy(*KEY)
        .orderBy("day", "is_end", "tranid")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ended = F.col("is_end")
    # A missing transaction must hide the one before it, so it is not skipped as NULL.
    tranid = F.coalesce("tranid", F.lit(_NO_TRANSACTION))
    last_day = F.last(F.when(ended, F.col("enddate")), ignorenulls=True).over(so_far)
    last_tranid = F.last(F.when(ended, tranid), ignorenulls=True).over(so_far)
    return events.select(
        "*",
        last_day.alias("previousenddate"),
        F.nullif(last_tranid, F.lit(_NO_TRANSACTION)).alias("previoustranid"),
    ).where(~ended)


def _previous(lines: DataFrame) -> DataFrame:
    # A line takes part twice, by its start and by its end. It is doubled after
    # the exchange, so it crosses the network once.
    takes_part = F.when(_usable_end(), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    doubled = lines.select("*", F.explode(takes_part).alias("is_end"))
    day = F.when(F.col("is_end"), F.col("enddate")).otherwise(F.col("startdate"))
    return _after_latest_end(doubled.select("*", day.alias("day"))).select(*lines.columns, *PREVIOUS)


# Neighbours by end date ------------------------------------------------------


def _gap_columns(before: Column, after: Column) -> list[Column]:
    return [
        F.datediff("startdate", before).alias("gapwithprevious"),
        F.datediff(after, "enddate").alias("gapwithnext"),
    ]


def _gaps(lines: DataFrame) -> DataFrame:
    others = [c for c in lines.columns if c not in (*KEY, *ORDER, *PREVIOUS)]
    by_end = Window.partitionBy(*KEY).orderBy(*[F.asc_nulls_last(c) for c in (*ORDER, *others)])
    return lines.select(
        "*", *_gap_columns(F.lag("enddate").over(by_end), F.lead("startdate").over(by_end))
    )


# Timelines too big for one task ----------------------------------------------


def _hot(lines: DataFrame) -> DataFrame:
    """The same columns as the windows give, from one row per pair of dates.

    Where a line stands depends only on its two dates, unless others share
    both; then only the first and the last of them look beyond the pair. So the
    lines are aggregated to their pairs of dates, on the map side first, and the
    windows run over those: what a task sorts is bounded by the square of the
    days the timeline spans, not by the number of lines. The lines then look
    their pair up by all four columns, which spreads a timeline over the
    cluster, and a single pair holding most lines is left to AQE to split: the
    other side of the join has one row for it.

    The first of a pair has the smallest transaction, among those the smallest
    line, among those the first of the other columns. Rows equal in all columns
    are counted first and written out again at the end: the first copy looks
    before the pair, the last one behind it.
    """
    dates = [*KEY, "startdate", "enddate"]
    place = [*dates, "tranid", "line_id"]
    others = [c for c in lines.columns if c not in place]
    distinct = lines.groupBy(*lines.columns).agg(F.count("*").alias("copies"))
    same = Window.partitionBy(*place)
    ranked = distinct.select(
        "*",
        F.row_number().over(same.orderBy(*[F.asc_nulls_last(c) for c in (others or ["line_id"])])).alias("variant"),
        F.count("*").over(same).alias("variants"),
    )
    # Two steps, so that every aggregate has a fixed width and none needs a sort.
    by_tranid = distinct.groupBy(*dates, "tranid").agg(
        F.min("line_id").alias("low"), F.max("line_id").alias("high")
    )
    missing = F.col("tranid").isNull()
    pairs = by_tranid.groupBy(*dates).agg(
        F.max("tranid").alias("tranid"),
        F.min("tranid").alias("first_tranid"),
        F.when(~F.max(missing), F.max("tranid")).alias("last_tranid"),
        F.coalesce(F.min_by("low", "tranid"), F.max(F.when(missing, F.col("low")))).alias("first_line"),
        F.coalesce(F.max(F.when(missing, F.col("high"))), F.max_by("high", "tranid")).alias("last_line"),
    )
    by_end = Window.partitionBy(*KEY).orderBy(
        F.asc_nulls_last("enddate"), F.asc_nulls_last("startdate")
    )
    lookup = _previous(pairs.repartition(*KEY)).select(
        *[F.col(c).alias(f"pair_{c}") for c in dates],
        "first_tranid",
        "last_tranid",
        "first_line",
        "last_line",
        F.lag("enddate").over(by_end).alias("end_before"),
        F.lead("startdate").over(by_end).alias("start_after"),
        *PREVIOUS,
    )
    match = null_safe_match(ranked, lookup, {c: f"pair_{c}" for c in dates})
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    out = ranked.join(lookup, match, "left").select("*", copies.alias("copy"))

    def stands(tranid: str, line: str, variant: Column, copy: Column) -> Column:
        return (
            F.col("tranid").eqNullSafe(F.col(tranid))
            & F.col("line_id").eqNullSafe(F.col(line))
            & (F.col("variant") == variant)
            & (F.col("copy") == copy)
        )

    opens = stands("first_tranid", "first_line", F.lit(1), F.lit(1))
    closes = stands("last_tranid", "last_line", F.col("variants"), F.col("copies"))
    return out.select(
        *lines.columns,
        *PREVIOUS,
        *_gap_columns(
            F.when(opens, F.col("end_before")).otherwise(F.col("enddate")),
            F.when(closes, F.col("start_after")).otherwise(F.col("startdate")),
        ),
    )


# Public operators ------------------------------------------------------------


def _in_order(lines: DataFrame, steps: list, added: list[str], hot, clustered: bool) -> DataFrame:
    if isinstance(hot, str):
        # The only place where an operator runs jobs of its own: see hot_timelines.
        hot = hot_timelines(lines)
    ordinary, big = (lines, None) if hot is None else split_by_keys(lines, KEY, hot)
    if not clustered:
        ordinary = ordinary.repartition(*KEY)
    for step in steps:
        ordinary = step(ordinary)
    if big is None:
        return ordinary
    return ordinary.unionByName(_hot(big).select(*lines.columns, *added))


def timeline(
    lines: DataFrame, hot: DataFrame | None | str = "detect", clustered: bool = False
) -> DataFrame:
    """Add the previous contract and both gaps to every line.

    ``hot`` names the timelines to compute by date pairs: the result of
    ``hot_timelines``, None for no such timeline, or "detect". Say ``clustered``
    for a table bucketed by (customerid, itemid): its windows need no exchange.
    """
    return _in_order(lines, [_previous, _gaps], PREVIOUS + GAPS, hot, clustered)


def previous_end(
    lines: DataFrame, hot: DataFrame | None | str = "detect", clustered: bool = False
) -> DataFrame:
    """Add the latest end date before the start, and its highest transaction."""
    return _in_order(lines, [_previous], PREVIOUS, hot, clustered)


def with_gaps(
    lines: DataFrame, hot: DataFrame | None | str = "detect", clustered: bool = False
) -> DataFrame:
    """Add the days since the previous end and until the next start."""
    return _in_order(lines, [_gaps], GAPS, hot, clustered)


def tag_new_renewal(lines: DataFrame) -> DataFrame:
    """Renewal where a previous end date was found, else New."""
    renewal = F.col("previousenddate").isNotNull()
    return lines.withColumn("ordertype", F.when(renewal, "Renewal").otherwise("New"))


def _is_broken() -> Column:
    return F.col("gapwithprevious") > 1


def broken_renewals(lines: DataFrame) -> DataFrame:
    """Lines that start more than a day after their neighbour ended; these are New."""
    return lines.where(_is_broken()).select(
        "tranid",
        *KEY,
        "startdate",
        "enddate",
        F.lit("New").alias("adjustedordertype"),
        *GAPS,
    )


def adjust_order_type(lines: DataFrame) -> DataFrame:
    """Turn broken renewals into New; a line with a missing key or date keeps its type."""
    return lines.withColumn(
        "ordertype", F.when(_is_broken() & _usable_end(), "New").otherwise(F.col("ordertype"))
    )


def order_types(lines: DataFrame, **options) -> DataFrame:
    """Every line with its previous contract, gaps and final order type."""
    return adjust_order_type(tag_new_renewal(timeline(lines, **options)))
