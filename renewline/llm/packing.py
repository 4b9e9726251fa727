"""Packing into batches of near-equal lengths, with optimal bucket boundaries.

A dynamic program over the histogram of lengths picks the boundaries that need the
least padding when every text is padded to the boundary of its bucket. Inside a
bucket, rows are numbered and cut into batches of ``budget`` padded tokens.

The histogram is exact below 2,048 tokens and holds 1,024 bins per doubling above, so
it has at most 22,528 bins whatever the data; a bin keeps its count, sum and largest
length, so padding is computed exactly and boundaries are lengths that occur. Between
two bins of the same upper range the choice is exact to a thousandth.

Null and empty texts have length 0. A text longer than the budget is a batch of its
own; no text is cut or dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import materialize, part_of, positions, row_salt

BUCKETS = 16
#: Padded tokens of a batch.
BUDGET = 16_384
#: Rows of a bucket that one task numbers.
ROWS_PER_TASK = 10_000
_EXACT = 2_048


def word_count(text: Column) -> Column:
    """Words of a text: runs without blanks and line breaks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")), F.lit(0))


def histogram(lengths: DataFrame, length: str = "n_tokens") -> list[tuple[int, int, int]]:
    """(largest length, rows, tokens) of every occupied bin, by length."""
    scale = f"CASE WHEN {length} < {_EXACT} THEN 0 ELSE length(bin({length})) - 11 END"
    rows = (
        lengths.groupBy(F.expr(scale).alias("scale"), F.expr(f"shiftright({length}, {scale})").alias("step"))
        .agg(F.max(length).alias("top"), F.count("*").alias("rows"), F.sum(length).alias("tokens"))
        .collect()
    )
    return sorted((r["top"], r["rows"], r["tokens"]) for r in rows)


def boundaries(bins: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Bucket boundaries of least padding, at most ``buckets`` of them, ascending.

    The cost of a range of bins satisfies the quadrangle inequality, so the best last
    cut moves forward with the end of the range and each layer is solved by halving.
    """
    if not bins:
        return []
    tops = np.array([b[0] for b in bins], np.float64)
    rows = np.concatenate(([0], np.cumsum([b[1] for b in bins], dtype=np.float64)))
    tokens = np.concatenate(([0], np.cumsum([b[2] for b in bins], dtype=np.float64)))
    n = len(bins)

    def padding(start: np.ndarray | int, end: int) -> np.ndarray:
        """Padding of bins start to end - 1 in one bucket."""
        return tops[end - 1] * (rows[end] - rows[start]) - (tokens[end] - tokens[start])

    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        after = np.full(n + 1, np.inf)
        after[0] = 0
        cut = np.zeros(n + 1, np.int64)
        ranges = [(1, n, 0, n - 1)]
        while ranges:
            low, high, first, last = ranges.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            starts = np.arange(first, min(last, mid - 1) + 1)
            costs = best[starts] + padding(starts, mid)
            pick = int(costs.argmin())
            after[mid], cut[mid] = costs[pick], starts[pick]
            ranges += [(low, mid - 1, first, int(starts[pick])), (mid + 1, high, int(starts[pick]), last)]
        best = after
        cuts.append(cut)
    out, end = [], n
    for cut in reversed(cuts):
        if end == 0:
            break
        out.append(int(tops[end - 1]))
        end = int(cut[end])
    return sorted(out)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per document: its length, bucket, padding, batch and slot in the batch.

    Batches are numbered from 0 within a bucket; rows come in a hashed order.
    """
    tokens = length if length is not None else word_count(F.col(text))
    # Texts are read once; the histogram and the numbering work on the narrow rows.
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"), tokens.cast("int").alias("n_tokens")))
    bins = histogram(rows)
    bounds = boundaries(bins, buckets) or [0]
    total = sum(b[1] for b in bins)
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    sizes = F.array(*(F.lit(b) for b in bounds))
    room = F.array(*(F.lit(max(1, budget // max(1, b))) for b in bounds))
    placed = rows.withColumn("bucket", bucket.cast("int"))
    order = ["doc_id", "n_tokens"]
    salt = part_of(order, row_salt(total, rows_per_task))
    placed = positions(placed, ["bucket"], [F.col(c) for c in order], salt)
    index = F.col("bucket") + 1
    return placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        F.element_at(sizes, index).alias("bucket_len"),
        (F.element_at(sizes, index) - F.col("n_tokens")).alias("padding"),
        F.floor(F.col("position") / F.element_at(room, index)).cast("long").alias("batch"),
        (F.col("position") % F.element_at(room, index)).cast("int").alias("slot"),
    )


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
