"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors with a fast pseudo-rotation (three rounds of random signs
and a Hadamard transform) and files each under its nearest signed axis. A query probes,
in every table, the axes it is nearest to; the rows filed there are scored exactly.

Nearness is the largest inner product of the original vectors. Candidates are put into
ranges of length, each reaching a fifth down from its longest, and filed by direction
within their range, so that angles order a range nearly as inner products do.
A query probes every range. Neighbouring ranges of few rows are joined into one bucket
that every query searches: long vectors are near at wide angles, where hashing misses.

Buckets are of any size: one above ``chunk_rows`` candidates or queries is cut into a
grid of chunks, each row of chunks meeting each column of chunks once, so no pair is
left out and no task holds more than a chunk of either side. A task returns the best of
its chunk for each query, never all pairs. A query that finds fewer rows than asked for
searches all buckets of the first table, which hold every row.

Vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do vectors of another number of components than most have. A query never finds rows of its own id;
rows that repeat an id count once, with their largest score. Ties go to the smaller id. A score beyond
doubles is infinite and stands first or last; one of infinite terms of both signs counts as the lowest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewline.llm.common import materialize

TABLES = 8
#: Axes that a query probes in each table and range, at least.
PROBES = 16
#: Longest length of a range by its shortest.
RANGE = 1.25
#: Where lengths differ, ranges below this many rows per neighbour asked for are searched whole.
WHOLE = 25
CHUNK_ROWS = 8_192
NEIGHBOURS = 20
#: Scores held at once.
_BLOCK = 1 << 20
_ROUNDS = 3


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, in place of a multiplication; length a power of two."""
    n, d = rows.shape
    half = 1
    while half < d:
        pairs = rows.reshape(n, d // (2 * half), 2, half)
        rows = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2)
        rows = rows.reshape(n, d)
        half *= 2
    return rows / np.sqrt(d)


def axes(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Signed coordinates of each vector after the pseudo-rotation: 2 d values per row."""
    out = np.zeros((len(vectors), signs.shape[1]))
    out[:, : vectors.shape[1]] = vectors
    for row in signs:
        out = hadamard(out * row)
    return np.concatenate([out, -out], axis=1)


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the logarithms of lengths; the largest component is taken out first."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    length = np.linalg.norm(scaled, axis=1, keepdims=True)
    return scaled / length, (np.log(largest) + np.log(length))[:, 0]


class Tables:
    """The pseudo-rotations of all tables, for vectors of ``dims`` components, and their ranges of length.

    ``longest`` and ``shortest`` are logarithms of lengths, as lengths themselves may not fit a double.
    """

    def __init__(self, dims: int, longest: float, shortest: float, tables: int = TABLES, seed: int = 11):
        self.longest = longest
        # A range of length reaches down to a fixed share of its longest; rounding opens none.
        self.ranges = 1 + max(0, int((longest - shortest) / np.log(RANGE) - 1e-6))
        self.dims = 1 << max(1, int(np.ceil(np.log2(dims))))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, _ROUNDS, self.dims))
        self.group(np.zeros(self.ranges, np.int64), 0)

    def group(self, sizes: np.ndarray, least: int) -> None:
        """Give each range its buckets; neighbouring ones of fewer than ``least`` rows share a single bucket."""
        least = least if self.ranges > 1 else 0
        self.first, self.hashed = np.zeros(self.ranges, np.int64), sizes >= least
        at = held = 0
        for i, n in enumerate(sizes.tolist()):
            # A joined bucket ends where a hashed range or one row too many follows.
            if held and (self.hashed[i] or held + n > least):
                at, held = at + 1, 0
            self.first[i] = at
            if self.hashed[i]:
                at += 2 * self.dims * len(self.signs)
            else:
                held += n
        # Each joined bucket once; ranges without rows need none.
        self.whole = np.unique(self.first[~self.hashed & (sizes > 0)])

    def range_of(self, vectors: np.ndarray) -> np.ndarray:
        """The range of length of each vector, from 0 for the longest."""
        down = (self.longest - directions(vectors)[1]) / np.log(RANGE) - 1e-6
        return np.clip(down.astype(np.int64), 0, self.ranges - 1)

    def file(self, vectors: np.ndarray) -> list[np.ndarray]:
        """One bucket per table for each candidate, or the only one of its range."""
        unit, _ = directions(vectors)
        found = [axes(unit, s).argmax(axis=1) + 2 * self.dims * t for t, s in enumerate(self.signs)]
        at = self.range_of(vectors)
        every = np.stack(found, axis=1) + self.first[at, None]
        return [row if hashed else np.array([first]) for row, hashed, first in zip(every, self.hashed[at], self.first[at])]

    def probe(self, vectors: np.ndarray, probes: int, tables: int | None = None) -> np.ndarray:
        """The nearest ``probes`` buckets per table and range for each query, and all joined buckets."""
        unit, _ = directions(vectors)
        probes = min(probes, 2 * self.dims)
        found = []
        for t, s in enumerate(self.signs[:tables]):
            near = np.argpartition(-axes(unit, s), probes - 1, axis=1)[:, :probes]
            found.append(near + 2 * self.dims * t)
        near = np.concatenate(found, axis=1)
        whole = np.broadcast_to(self.whole, (len(vectors), len(self.whole)))
        return np.concatenate([*(near + first for first in self.first[self.hashed]), whole], axis=1)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int, float, float]:
    """Rows that take part as (id, v), their dimension, largest and smallest length as logarithms."""
    v = F.col("v").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Single-precision vectors are moved as they are and widened where they are scored.
    kind = vectors.schema[vector].dataType.simpleString()
    moved = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), moved.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.where(finite & F.exists(v, lambda x: x != 0))
    # Without the largest component no square leaves the range of doubles.
    largest = F.array_max(F.transform(v, F.abs))
    shares = F.zip_with(v, F.array_repeat(largest, F.size(v)), lambda x, most: x / most)
    length = F.ln(largest) + 0.5 * F.ln(F.aggregate(shares, F.lit(0.0), lambda s, x: s + x * x))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(length).alias("longest"), F.min(length).alias("shortest")
    )
    most = sizes.orderBy(F.desc("n"), "d").first()
    if most is None:
        return rows, 0, 0.0, 0.0
    return rows.where(F.size("v") == most["d"]), most["d"], most["longest"], most["shortest"]


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def _with_buckets(rows: DataFrame, dims: int, buckets) -> DataFrame:
    """Add the array of buckets that ``buckets`` computes for the vectors."""

    def add(batches):
        for batch in batches:
            if batch.num_rows:
                found = buckets(_matrix(batch.column(1), dims))
                offsets = np.cumsum([0, *(len(row) for row in found)], dtype=np.int32)
                listed = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.record_batch([*batch.columns, listed], names=["id", "v", "b"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.select("id", "v").mapInArrow(add, f"id long, v {kind}, b array<int>")


def _range_sizes(rows: DataFrame, dims: int, index: Tables) -> np.ndarray:
    """Rows in each range of length."""

    def count(batches):
        sizes = np.zeros(index.ranges, np.int64)
        for batch in batches:
            if batch.num_rows:
                sizes += np.bincount(index.range_of(_matrix(batch.column(0), dims)), minlength=index.ranges)
        held = np.flatnonzero(sizes)
        yield pa.record_batch([pa.array(held), pa.array(sizes[held])], names=["range", "n"])

    found = rows.select("v").mapInArrow(count, "range long, n long").groupBy("range").agg(F.sum("n").alias("n"))
    sizes = np.zeros(index.ranges, np.int64)
    for r in found.collect():
        sizes[r["range"]] = r["n"]
    return sizes


def _best(query_ids, queries, ids, vectors, count: int):
    """Per query the ``count`` candidates of largest score, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    step = max(1, _BLOCK // max(1, len(ids)))
    out = []
    for at in range(0, len(queries), step):
        # Summed in the same order for every pair, so equal vectors score equal.
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.einsum("qd,cd->qc", queries[at : at + step], vectors)
        scores[np.isnan(scores)] = -np.inf
        own = query_ids[at : at + step, None] == ids[None, :]
        scores[own] = -np.inf
        if len(ids) > count:
            bound = -np.partition(-scores, count - 1, axis=1)[:, count - 1]
            row, col = np.nonzero((scores >= bound[:, None]) & ~own)
        else:
            row, col = np.nonzero(~own)
        value = scores[row, col]
        order = np.lexsort((ids[col], -value, row))
        row, col, value = row[order], col[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < count
        out.append((query_ids[at : at + step][row[kept]], ids[col[kept]], value[kept]))
    return [np.concatenate(x) for x in zip(*out)]


def _search(candidates: DataFrame, queries: DataFrame, dims: int, count: int, chunk_rows: int) -> DataFrame:
    """Best rows per query and bucket; both sides have columns id, v, b (buckets)."""
    left = candidates.select("id", "v", F.explode("b").alias("bucket"))
    right = queries.select("id", "v", F.explode("b").alias("bucket"))
    sizes = left.groupBy("bucket").agg(F.count("*").alias("c"), F.lit(0).alias("q")).unionByName(
        right.groupBy("bucket").agg(F.lit(0).alias("c"), F.count("*").alias("q"))
    )
    # At most one row per bucket, so a bounded number, and small.
    sizes = sizes.groupBy("bucket").agg(F.sum("c").alias("c"), F.sum("q").alias("q"))
    large = sizes.where((F.col("c") > chunk_rows) | (F.col("q") > chunk_rows)).collect()
    grid = {r["bucket"]: (-(-r["c"] // chunk_rows), -(-r["q"] // chunk_rows)) for r in large}

    def cuts(side: int):
        """Chunks of a side in each bucket, 1 unless it is large."""
        if not grid:
            return F.lit(1)
        found = F.create_map(*(F.lit(x) for b, n in grid.items() for x in (b, max(1, n[side]))))
        return F.coalesce(F.try_element_at(found, F.col("bucket")), F.lit(1))

    def chunk(side: int):
        return F.pmod(F.xxhash64("id"), cuts(side)).cast("int")

    def every(side: int):
        return F.explode(F.sequence(F.lit(0), (cuts(side) - 1).cast("int")))

    left = left.withColumn("row", chunk(0)).withColumn("column", every(1))
    right = right.withColumn("column", chunk(1)).withColumn("row", every(0))
    key = ["bucket", "row", "column"]

    def score(cell: pa.Table, asked: pa.Table) -> pa.Table:
        if not cell.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, c, s = _best(
            asked["id"].to_numpy(), _matrix(asked["v"], dims), cell["id"].to_numpy(), _matrix(cell["v"], dims), count
        )
        return pa.table({"query_id": q, "vec_id": c, "score": s})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(score, "query_id long, vec_id long, score double")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def nearest(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    count: int = NEIGHBOURS,
    tables: int = TABLES,
    probes: int = PROBES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (double).

    Queries are the rows whose id is divisible by ``every``; each gets its ``count``
    nearest rows found, or all rows if there are fewer.
    """
    rows, dims, longest, shortest = usable(vectors, vec_id, vector)
    if not dims:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = Tables(dims, longest, shortest, tables)
    if index.ranges > 1:
        index.group(_range_sizes(rows, dims, index), WHOLE * count)
    # More axes need more probes for the same recall.
    probes = max(probes, index.dims // 3 if index.dims > 64 else 0)
    asked = rows.where(F.col("id") % every == 0)
    # Hashed once; the bucket counts and the search both read the stored buckets.
    filed = materialize(_with_buckets(rows, dims, index.file))
    probed = materialize(_with_buckets(asked, dims, lambda v: index.probe(v, probes)))
    found = _search(filed, probed, dims, count, chunk_rows)
    found = materialize(_top(found, count))
    enough = found.groupBy("query_id").count().where(F.col("count") >= count)
    short = materialize(asked.join(enough, asked.id == enough.query_id, "left_anti"))
    if not short.isEmpty():
        wide = _with_buckets(short, dims, lambda v: index.probe(v, 2 * index.dims, 1))
        first = filed.withColumn("b", F.slice("b", 1, 1))
        more = _search(first, wide, dims, count, chunk_rows)
        found = found.join(short, found.query_id == short.id, "left_anti").select("query_id", "rank", "vec_id", "score")
        found = found.unionByName(_top(more, count))
    return found


def _top(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
