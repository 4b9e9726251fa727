"""Ordering again only those timelines that new lines touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewline.operators.skew import split_by_keys
from renewline.operators.timeline import KEY, hot_timelines, order_types


def hot_in_either(stored: DataFrame, batch: DataFrame) -> DataFrame | None:
    """Timelines that hold too many lines for one task, stored and new ones together, or None."""
    return hot_timelines(stored.select(*KEY).unionByName(batch.select(*KEY)))


def touched(stored: DataFrame, batch: DataFrame, big: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored rows outside and inside the timelines of the batch; a missing customer or item is a key as any other.

    ``big`` names the few timelines that are too big for one task, as ``hot_in_either`` finds them. Those of them
    that the batch touches are broadcast, so the rows of a big timeline are not brought together.
    """
    keys = batch.select(*KEY).distinct()
    if big is None:
        return split_by_keys(stored, KEY, keys)
    ordinary, large = split_by_keys(stored, KEY, big)
    _, large_keys = split_by_keys(keys, KEY, big)
    outside, inside = split_by_keys(ordinary, KEY, keys)
    large_outside, large_inside = split_by_keys(large, KEY, F.broadcast(large_keys))
    return outside.unionByName(large_outside), inside.unionByName(large_inside)


def reorder(
    stored: DataFrame, batch: DataFrame, big: DataFrame | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """The stored rows of all timelines that the batch touches, and the typed rows that replace them.

    ``stored`` holds typed lines with the columns of the batch, and others. Lines whose id is stored already are
    not added again, so a batch can be run twice. ``big`` goes to ``touched``, ``options`` go to the timeline operators.
    """
    _, before = touched(stored, batch, big)
    lines = before.select(*batch.columns)
    fresh = batch.join(lines.select("line_id").distinct(), "line_id", "left_anti").select(*batch.columns)
    return before, order_types(lines.unionByName(fresh), **options)
