"""Hard-negative mining by segment summary filtering.

A vector is cut into segments. With the mean and the deviation of a segment of m components
stored, the part of an inner product that falls on the segment is bounded: it is m times the
product of the means, plus or minus at most m times the product of the deviations. Bounds
of a few long segments come first, those of more and shorter segments where they leave a pair
open, and only what is then open is scored exactly. Scores are integers and exact.

An anchor's positives are its nearest rows of the same label. A hard negative for a
positive is a row of another label whose score lies between a share of the positive's score
and that score; the nearest ones are returned.

Anchors and rows are dealt into chunks of bounded size by their ids, and every chunk of
anchors meets every chunk of rows in a task of its own, so no task grows with a label and no
pair is left out. A task returns its best rows for each anchor only.

Rows with a null id, label or vector, or a null or non-finite component take no part. A
vector is compared with those of its own length. An id that repeats counts once, with its smallest
label and vector. Components beyond 2^31 once scaled count as that, and scores end at what a long holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewline.llm.common import materialize

ANCHORS_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least so much in a hundred of its positive.
SHARE = 80
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Segments of a vector, level by level.
LEVELS = (4, 16)
CHUNK_ROWS = 8_192
CHUNK_ANCHORS = 1_024
#: Anchors whose bounds are held at once.
BLOCK = 64

_LARGEST = 1 << 31
_LONG = 2**63 - 1
#: Above this, doubles no longer hold all sums of products.
_EXACT = 1 << 53


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(vectors * scale), -_LARGEST, _LARGEST).astype(np.int64)


def summaries(rows: np.ndarray) -> np.ndarray:
    """For each level the means, then the deviations of all segments, times the root of a segment's length.

    The product of two rows' means plus that of their deviations then bounds the inner product from above.
    """
    parts = []
    for count in LEVELS:
        cuts = np.linspace(0, rows.shape[1], min(count, rows.shape[1]) + 1).astype(int)
        segments = [rows[:, a:b].astype(np.float64) for a, b in zip(cuts, cuts[1:])]
        parts += [s.mean(axis=1) * np.sqrt(s.shape[1]) for s in segments]
        parts += [s.std(axis=1) * np.sqrt(s.shape[1]) for s in segments]
    return np.stack(parts, axis=1) if parts else np.zeros((len(rows), 0))


class Side:
    """Vectors of one length with their ids, labels and summaries."""

    def __init__(self, table: pa.Table, dims: int):
        self.ids = table["id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.vectors = _matrix(table["q"], dims)
        every = _matrix(table["s"], 2 * sum(min(c, dims) for c in LEVELS)).astype(np.float64)
        self.levels, at = [], 0
        for count in (min(c, dims) for c in LEVELS):
            self.levels.append((every[:, at : at + count], every[:, at + count : at + 2 * count]))
            at += 2 * count
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.norm = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.ids)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims)


def _products(left, right, rows: np.ndarray, columns: np.ndarray, exact: bool = False):
    """Products of the listed pairs of rows; pairs that fill a good part of the rectangle are taken from it."""
    if exact and left.largest * right.largest * max(1, left.vectors.shape[1]) >= _EXACT:
        a, b = left.vectors.astype(object), right.vectors.astype(object)
        found = [int((a[i] * b[j]).sum()) for i, j in zip(rows.tolist(), columns.tolist())]
        return np.array([max(-_LONG - 1, min(_LONG, x)) for x in found], np.int64)
    a, b = (left.vectors, right.vectors) if exact else (left, right)
    used, at = np.unique(columns, return_inverse=True)
    first = int(rows.min(initial=0))
    height = int(rows.max(initial=0)) + 1 - first
    if len(rows) * 8 > height * len(used):
        whole = a[first : first + height].astype(np.float64) @ b[used].astype(np.float64).T
        found = whole[rows - first, at]
    else:
        step = max(1, (1 << 22) // max(1, a.shape[1]))
        parts = [
            np.einsum("pd,pd->p", a[rows[i : i + step]].astype(np.float64), b[columns[i : i + step]].astype(np.float64))
            for i in range(0, len(rows), step)
        ]
        found = np.concatenate(parts) if parts else np.zeros(0)
    return np.rint(found).astype(np.int64) if exact else found


def _nth_best(keys: np.ndarray, scores: np.ndarray, count: int, n_keys: int, missing: np.ndarray) -> np.ndarray:
    """The score of rank ``count`` of each key, or its ``missing`` value where it has fewer."""
    order = np.lexsort((-scores, keys))
    keys, scores = keys[order], scores[order]
    rank = np.arange(len(keys)) - np.searchsorted(keys, keys)
    out = missing.copy()
    out[keys[rank == count - 1]] = scores[rank == count - 1]
    return out


def search(
    anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, same_label: bool, count: int
) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score): for each anchor and window its best rows with low <= score <= high.

    ``low`` and ``high`` are integers, one row per anchor and one column per window; a window with low above
    high takes nothing. Equal scores go to smaller ids.
    """
    found = [_search_block(anchors, rows, low, high, same_label, count, at) for at in range(0, len(anchors), BLOCK)]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


def _search_block(anchors, rows, low, high, same_label, count, at):
    end = min(at + BLOCK, len(anchors))
    low, high = low[at:end], high[at:end]
    windows = low.shape[1]
    fits = (anchors.labels[at:end, None] == rows.labels[None, :]) == same_label
    fits &= anchors.ids[at:end, None] != rows.ids[None, :]
    a, r = np.nonzero(fits)
    needed = low.astype(np.float64)
    for level, (ours, theirs) in enumerate(zip(anchors.levels, rows.levels)):
        if not len(a):
            break
        middle = _products(ours[0], theirs[0], a + at, r)
        spread = _products(ours[1], theirs[1], a + at, r)
        # Covers rounding in means, deviations and products.
        spread = spread + 1e-9 * anchors.norm[a + at] * rows.norm[r] + 1e-6
        upper, lower = (np.clip(x, -float(_LONG), float(_LONG)) for x in (middle + spread, middle - spread))
        if level == 0:
            # Exact scores of the most promising rows that lie under a window's upper end raise its lower end.
            for w in range(windows):
                under = np.flatnonzero(upper <= high[a, w])
                order = under[np.lexsort((-upper[under], a[under]))]
                first = np.searchsorted(a[order], a[order])
                order = order[np.arange(len(order)) - first < count]
                score = _products(anchors, rows, a[order] + at, r[order], exact=True)
                kept = score >= low[a[order], w]
                needed[:, w] = np.maximum(
                    needed[:, w], _nth_best(a[order][kept], score[kept], count, end - at, low[:, w]).astype(np.float64)
                )
        open_ = np.zeros(len(a), bool)
        for w in range(windows):
            open_ |= (upper >= needed[a, w]) & (lower <= high[a, w]) & (low[a, w] <= high[a, w])
        a, r = a[open_], r[open_]
    score = _products(anchors, rows, a + at, r, exact=True)
    out = []
    for w in range(windows):
        inside = np.flatnonzero((score >= low[a, w]) & (score <= high[a, w]))
        order = inside[np.lexsort((rows.ids[r[inside]], -score[inside], a[inside]))]
        first = np.searchsorted(a[order], a[order])
        order = order[np.arange(len(order)) - first < count]
        out.append((a[order] + at, np.full(len(order), w), r[order], score[order]))
    return tuple(np.concatenate(c) for c in zip(*out))


def prepared(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """Rows that take part as (id, label, q, s): integer vectors and their stored summaries."""
    v = F.col("v")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()).where(finite)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")

    def summarise(batches):
        for batch in batches:
            column = batch.column(2)
            sizes = np.diff(column.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == d))
                q = quantised(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d), scale)
                s = summaries(q)
                listed = [
                    pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                    for x in (q, s)
                ]
                yield pa.record_batch([part.column(0), part.column(1), *listed], names=["id", "label", "q", "s"])

    return rows.mapInArrow(summarise, "id long, label long, q array<long>, s array<double>")


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int):
    """Both sides grouped so that every chunk of anchors meets every chunk of rows."""
    down, across = max(1, -(-n_rows // CHUNK_ROWS)), max(1, -(-n_anchors // CHUNK_ANCHORS))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("across", own(across)).withColumn("down", every(down))
    right = rows.withColumn("down", own(down)).withColumn("across", every(across))
    return left.groupBy("down", "across").cogroup(right.groupBy("down", "across"))


def _sides(asked: pa.Table, cell: pa.Table):
    """Anchors and rows of a cell for each length of vectors that both have."""
    lengths = [np.diff(t["q"].combine_chunks().offsets.to_numpy()) if t.num_rows else np.zeros(0, np.int64) for t in (asked, cell)]
    for d in np.intersect1d(*lengths).tolist():
        part, rows = (t.filter(pa.array(n == d)) for t, n in zip((asked, cell), lengths))
        yield part, Side(part, d), Side(rows, d)


def _ranked(found: DataFrame, key: list[str], score: str, row: str, count: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = ANCHORS_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: int = SHARE,
    scale: int = SCALE,
) -> DataFrame:
    """Columns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose id is divisible by ``every``. Each has its ``positives`` best rows of its label (all, if
    fewer), and each of those its ``negatives`` best rows of another label with share * positive score <= 100 * negative
    score <= 100 * positive score; so there are none for a positive of negative score.
    """
    rows = materialize(prepared(vectors, vec_id, vector, label, scale))
    anchors = rows.where(F.col("id") % every == 0)
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if(F.col("id") % every == 0).alias("anchors")).first()

    def nearest(asked: pa.Table, cell: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        for _, a, r in _sides(asked, cell):
            whole = np.full((len(a), 1), _LONG)
            i, _, j, score = search(a, r, -whole - 1, whole, True, positives)
            out.append((a.ids[i], r.ids[j], score))
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), map(np.concatenate, zip(*out)))))

    found = _cells(anchors, rows, sizes["anchors"], sizes["rows"]).applyInArrow(
        nearest, "anchor_id long, positive_id long, positive_score long"
    )
    best = _ranked(found, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank")
    listed = best.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("positive_score", "positive_id"))).alias("p")
    )
    asked = anchors.join(listed, anchors.id == listed.anchor_id).select(
        "id", "label", "q", "s", F.col("p.positive_id").alias("p_id"), F.col("p.positive_score").alias("p_score")
    )
    asked = materialize(asked)

    def between(asked: pa.Table, cell: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 5]
        for part, a, r in _sides(asked, cell):
            ids, scores = part["p_id"].to_pylist(), part["p_score"].to_pylist()
            low, high = np.full((len(a), positives), 0), np.full((len(a), positives), -1)
            for i, row in enumerate(scores):
                for w, score in enumerate(row):
                    low[i, w], high[i, w] = -(-share * score // 100), score
            i, w, j, score = search(a, r, low, high, False, negatives)
            of = [(ids[x][y], scores[x][y]) for x, y in zip(i.tolist(), w.tolist())]
            of = np.array(of, np.int64).reshape(-1, 2)
            out.append((a.ids[i], of[:, 0], r.ids[j], of[:, 1], score))
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        return pa.table(dict(zip(names, map(np.concatenate, zip(*out)))))

    found = _cells(asked, rows, sizes["anchors"], sizes["rows"]).applyInArrow(
        between, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    ranked = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, after the labels of every seventh id were moved on by one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))
