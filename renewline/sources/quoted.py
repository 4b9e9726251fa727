"""Records of CSV files whose quoted fields hold line breaks, without reading a file in one task.

A line break ends a record if the quotes before it, from the beginning of the file, are even in
number. A split of a file knows its own quotes only, so a first pass counts them per split; a
running sum over the splits of a file then says whether each split begins within quotes, and in which
record. A line whose own quotes are even and that begins outside of quotes is a record and stays where
it is. Only the lines of longer records are exchanged, to be joined in order.

A quote that is never closed makes the rest of its file one record, as any reader has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
_SPLIT = ["path", "block"]


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Physical lines with their file and the offset of their split, in order within a partition."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def _numbered(batches):
    """Each line with its number in the split, its quotes, and the last line up to it that has an even or odd number before.

    The latter are the beginning of its record if the split begins outside or within quotes.
    """
    key, lines, quotes, last = None, 0, 0, [-1, -1]
    for batch in batches:
        if not batch.num_rows:
            continue
        own = pc.count_substring(batch.column(2), QUOTE.encode()).to_numpy(zero_copy_only=False).astype(np.int64)
        paths, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        cuts = [i for i in range(1, len(paths)) if (paths[i], blocks[i]) != (paths[i - 1], blocks[i - 1])]
        for low, high in zip([0, *cuts], [*cuts, len(paths)]):
            if (paths[low], blocks[low]) != key:
                key, lines, quotes, last = (paths[low], blocks[low]), 0, 0, [-1, -1]
            number = np.arange(lines, lines + high - low)
            before = quotes + np.cumsum(own[low:high]) - own[low:high]
            starts = [np.maximum(np.maximum.accumulate(np.where(before % 2 == p, number, -1)), last[p]) for p in (0, 1)]
            lines, quotes, last = lines + high - low, quotes + int(own[low:high].sum()), [int(s[-1]) for s in starts]
            part = batch.slice(low, high - low)
            yield pa.record_batch(
                [*part.columns, *map(pa.array, (number, own[low:high], before, *starts))],
                names=["path", "block", "value", "line", "quotes", "before", "even", "odd"],
            )


def whole_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Columns ``path``, ``first`` (the record that begins the file) and ``record`` (its bytes, without the last line break)."""
    schema = "path string, block long, value binary, line long, quotes long, before long, even long, odd long"
    lines = _lines(spark, paths).mapInArrow(_numbered, schema)
    splits = lines.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.max("even").alias("last_even"), F.max("odd").alias("last_odd")
    )
    # One row for each split of a file, so a window holds the splits of one file.
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    splits = splits.withColumn("within", begun)
    last = F.when(F.col("within") == 0, F.col("last_even")).otherwise(F.col("last_odd"))
    opened = F.last(F.when(last >= 0, F.struct(F.col("block").alias("block"), last.alias("line"))), ignorenulls=True)
    splits = splits.select(*_SPLIT, "within", opened.over(earlier).alias("open"))
    placed = lines.join(splits, _SPLIT)
    own = F.when(F.col("within") == 0, F.col("even")).otherwise(F.col("odd"))
    start = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("line"))).otherwise(F.col("open"))
    placed = placed.withColumn("start", start)
    alone = ((F.col("before") + F.col("within")) % 2 == 0) & (F.col("quotes") % 2 == 0)
    first = (F.col("start.block") == 0) & (F.col("start.line") == 0)
    ends = placed.where(alone).select("path", first.alias("first"), F.col("value").alias("record"))
    pieces = placed.where(~alone).groupBy("path", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("pieces")
    )
    broken = F.aggregate(
        F.slice("pieces", 2, F.size("pieces")),
        F.col("pieces")[0]["value"],
        lambda text, piece: F.concat(text, F.lit(b"\n"), piece["value"]),
    )
    return ends.unionByName(pieces.select("path", first.alias("first"), broken.alias("record")))
