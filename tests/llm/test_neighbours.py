from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from renewline.llm import neighbours
from tests.llm import data


def table(spark, vectors):
    rows = [(i, v, 0, "x", 1.0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, bucket string, score double")


def brute(vectors: dict[int, np.ndarray], count: int = 20) -> dict[int, list[tuple[int, float]]]:
    out = {}
    for q, v in vectors.items():
        if q % 20 == 0:
            scored = [(float((v * w).sum()), i) for i, w in vectors.items() if i != q]
            out[q] = [(i, s) for s, i in sorted(scored, key=lambda x: (-x[0], x[1]))[:count]]
    return out


def collected(df):
    found = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def recall(found, expected):
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in found[q]}) for q in expected)
    return hits / sum(len(e) for e in expected.values())


@pytest.mark.parametrize("chunk_rows", [8_192, 40])
@pytest.mark.parametrize("scaled", [False, True])
def test_recall_and_scores(spark, tmp_path, chunk_rows, scaled):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1_500, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scaled:
        x *= rng.uniform(0.5, 2, (1_500, 1))
    vectors = {i: v.astype(np.float32).astype(np.float64) for i, v in enumerate(x)}
    found = collected(neighbours.nearest(table(spark, [v.tolist() for v in x]), chunk_rows=chunk_rows))
    expected = brute(vectors)
    assert found.keys() == expected.keys() and all(len(f) == 20 for f in found.values())
    assert recall(found, expected) >= 0.9
    for q, rows in found.items():
        assert all(abs(s - float(vectors[q] @ vectors[i])) < 1e-12 for i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_equal_vectors_rank_by_id(spark):
    base = np.random.default_rng(3).normal(size=16).tolist()
    found = collected(neighbours.nearest(table(spark, [base] * 300), chunk_rows=50))
    for q, rows in found.items():
        assert [i for i, _ in rows] == [i for i in range(22) if i != q][:20]


def test_fewer_rows_than_asked_for(spark):
    x = np.random.default_rng(4).normal(size=(9, 8))
    found = collected(neighbours.nearest(table(spark, x.tolist())))
    expected = brute({i: v.astype(np.float32).astype(np.float64) for i, v in enumerate(x)})
    assert [i for i, _ in found[0]] == [i for i, _ in expected[0]]


def test_unusable_vectors_take_no_part(spark):
    good = [float(i + 1) for i in range(4)]
    rows = [good, None, [], [0.0] * 4, [1.0, None, 1.0, 1.0], [1.0, float("nan"), 0.0, 0.0], [float("inf")] * 4, [1.0] * 3, good, [2.0] * 4]
    df = table(spark, rows).union(table(spark, [good]).withColumn("vec_id", F.lit(None).cast("long")))
    df = df.union(df.where("vec_id = 8"))
    found = collected(neighbours.nearest(df))
    assert [i for i, _ in found[0]] == [8, 9]


def test_empty_table_and_query(spark, tmp_path):
    folder = data.parquet(table(spark, []), tmp_path, "embeddings")
    assert neighbours.op9_nearest_neighbours(spark, folder).columns == ["query_id", "rank", "vec_id", "score"]
    assert neighbours.op9_nearest_neighbours(spark, folder).count() == 0


def test_rotation_keeps_angles():
    x = np.random.default_rng(5).normal(size=(20, 24))
    turned = neighbours.axes(x, neighbours.Tables(24, 1.0, 1.0).signs[0])[:, :32]
    assert np.allclose(turned @ turned.T, x @ x.T)


@pytest.mark.parametrize("lengths", ["outlier", "uniform", "lognormal"])
def test_recall_where_lengths_differ(spark, lengths):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "outlier":
        x[7] *= 2
    else:
        x *= (rng.uniform(0.5, 2, 4_000) if lengths == "uniform" else rng.lognormal(size=4_000))[:, None]
    vectors = {i: v.astype(np.float32).astype(np.float64) for i, v in enumerate(x)}
    found = collected(neighbours.nearest(table(spark, [v.tolist() for v in x])))
    expected = brute(vectors)
    assert found.keys() == expected.keys() and all(len(f) == 20 for f in found.values())
    got = recall(found, expected)
    print(f"recall {lengths} {got:.4f}")
    assert got >= 0.95


def test_every_range_has_its_buckets():
    index = neighbours.Tables(8, 4.0, 0.001)
    sizes = np.array([3, 0, 4, 900, 2, 0, 5, 700, *[6] * (index.ranges - 8)])
    index.group(sizes, 10)
    assert index.hashed.tolist() == [n >= 10 for n in sizes]
    # Ranges that share a bucket lie side by side and hold no more rows than one may.
    for first in index.whole:
        at = np.flatnonzero(index.first == first)
        assert at.tolist() == list(range(at[0], at[-1] + 1)) and sizes[at].sum() <= 10 and not index.hashed[at].any()
    starts = [(f, 2 * index.dims * len(index.signs) if h else 1) for f, h in sorted(set(zip(index.first.tolist(), index.hashed.tolist())))]
    assert all(f + n <= g for (f, n), (g, _) in zip(starts, starts[1:]))


@pytest.mark.parametrize("scale", [1e200, 1e-200, 1e300, 5e-324])
def test_lengths_beyond_doubles(spark, scale):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 8))
    x[7] = np.where(x[7] >= 0, 1.0, -1.0) * scale
    x[40] *= 1e3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collected(neighbours.nearest(docs))
    expected = brute({i: np.array(v) for i, v in rows})
    assert found.keys() == expected.keys() and all(len(f) == 20 for f in found.values())
    assert recall(found, expected) >= 0.9


def test_scores_beyond_doubles_have_an_order(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [-1e200, -1e200]), (4, [1.0, 1.0]), (5, [1e200, 1e199])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collected(neighbours.nearest(docs))[0]
    assert [i for i, _ in found] == [1, 5, 4, 2, 3]
    assert [s for _, s in found] == [np.inf, np.inf, 2e200, -np.inf, -np.inf]
