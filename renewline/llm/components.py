"""Connected components of a link table, without any vertex or link on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewline.llm.common import materialize


def connected_components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """Columns ``node`` and ``root``: every linked node with the smallest node it reaches.

    Large-star and small-star steps alternate until the links form stars. A step
    hooks every neighbour of a node to the smallest one, so the number of links
    never grows and the rounds grow with the logarithm of the longest path. Each
    round is written to the shared folder; only a count and a checksum come back.
    A null end makes no link; a node linked to itself alone is left out.
    """
    a, b = F.col(first), F.col(second)
    ordered = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = materialize(ordered.distinct())
    seen = None
    while True:
        mark = stars.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("checksum"),
        ).first()
        if mark == seen:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                stars.select(F.col("v"), F.col("v")).distinct()
            )
        seen = mark
        stars = materialize(_small_star(_large_star(stars)))


def _large_star(links: DataFrame) -> DataFrame:
    """Hook every larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hook every smaller neighbour of a node, and the node, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    hooked = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(least.select("u", F.col("m").alias("v"))).distinct()
