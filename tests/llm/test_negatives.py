"""Hard negatives against all inner products in whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from renewline.llm import negatives
from tests.llm import data

SCHEMA = "vec_id long, embedding array<double>, label int, q int, id string, s long, down int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def product(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def brute(rows, every=100, moved=True):
    """The contract's result by comparing every anchor with every row."""
    kept = {}
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if moved and vec_id % 7 == 0 else label
        kept[vec_id] = min(kept.get(vec_id, (label, v)), (label, v))
    whole = {i: (label, [max(-(2**31), min(2**31, math.floor(256 * x))) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for anchor, (label, q) in whole.items():
        if anchor % every:
            continue
        scored = [(-product(q, p), i, other) for i, (other, p) in whole.items() if i != anchor and len(p) == len(q)]
        scored.sort()
        for best, positive, _ in [x for x in scored if x[2] == label][:5]:
            hard = [x for x in scored if x[2] != label and -80 * best <= -100 * x[0] <= -100 * best]
            out += [(anchor, positive, n, i, -best, -s) for n, (s, i, _) in enumerate(hard[:5], 1)]
    return sorted(out)


def result(spark, rows, tmp_path):
    folder = data.parquet(table(spark, rows), tmp_path, "embeddings")
    found = negatives.op13_hard_negatives(spark, folder)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(tuple(r) for r in found.collect())


def clustered(seed, count, dims, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    vectors = centres[rng.integers(0, 5, count)] + 0.6 * rng.normal(size=(count, dims))
    return [(i * 25, v.tolist(), int(rng.integers(0, labels))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("dims", [64, 7, 3])
def test_query_equals_brute_force(spark, tmp_path, dims):
    rows = clustered(dims, 400, dims)
    want = brute(rows)
    assert len(want) > 100
    assert result(spark, rows, tmp_path) == want


def test_small_chunks_and_one_label_with_most_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 50)
    monkeypatch.setattr(negatives, "CHUNK_ANCHORS", 20)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    rows = [(i, v, 1 if i % 4 else label) for i, v, label in clustered(9, 500, 20)]
    assert result(spark, rows, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i * 20, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], rng.randrange(2)) for i in range(80)]
    rows += [(100, [1.0] * 4, 0), (100, [1.0] * 4, 0), (20, [0.0] * 4, 1), (None, [1.0] * 4, 1), (300, None, 1)]
    rows += [(500, [1.0, None, 0.0, 0.0], 1), (700, [float("nan")] * 4, 0), (900, [float("inf")] * 4, 0)]
    rows += [(1100, [1.0] * 4, None), (1300, [], 0), (1500, [], 1), (1301, [], 0), (1700, [2.0], 0), (1702, [2.0], 0), (1703, [1.9], 1)]
    rows += [(-100, [1.0, 1.0, 0.5, 0.5], 1), (-3, [1.0, 1.0, 0.5, 0.5], 0)]
    want = brute(rows)
    assert {r[0] for r in want} & {-100, 1700}
    assert result(spark, rows, tmp_path) == want


def test_huge_components_are_exact(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i * 50, [rng.choice([1e5, 1e6, -3e5, 1e300, 1e-300]) * rng.random() for _ in range(6)], i % 3) for i in range(60)]
    assert result(spark, rows, tmp_path) == brute(rows)


def test_no_rows_and_no_anchors(spark, tmp_path):
    assert result(spark, [], tmp_path) == []
    assert result(spark, [(1, [1.0], 0), (2, [1.0], 1)], tmp_path / "b") == []


def test_bounds_hold_and_skip_pairs(monkeypatch):
    rng = np.random.default_rng(2)
    # Long runs of like components: coarse segments tell far rows from near ones.
    q = negatives.quantised(np.repeat(rng.normal(size=(300, 4)), 16, axis=1) + 0.05 * rng.normal(size=(300, 64)), 256)
    s = negatives.summaries(q)
    listed = {
        "id": np.arange(300), "label": np.zeros(300, np.int64), "q": pa.array(q.tolist(), pa.list_(pa.int64())),
        "s": pa.array(s.tolist(), pa.list_(pa.float64())),
    }
    side = negatives.Side(pa.table(listed), 64)
    exact = q @ q.T
    for means, devs in side.levels:
        middle, spread = means @ means.T, devs @ devs.T + 1e-6
        assert (exact <= middle + spread * (1 + 1e-9)).all() and (exact >= middle - spread * (1 + 1e-9)).all()
    scored = []
    products = negatives._products
    monkeypatch.setattr(negatives, "_products", lambda a, b, r, c, exact=False: scored.append(len(r) * exact) or products(a, b, r, c, exact))
    whole = np.full((300, 1), 2**63 - 1)
    a, _, r, score = negatives.search(side, side, -whole - 1, whole, True, 5)
    assert sum(scored) < 300 * 300 / 5
    for i in range(300):
        want = sorted((-exact[i, j], j) for j in range(300) if j != i)[:5]
        assert list(zip((-score[a == i]).tolist(), r[a == i].tolist())) == [(int(x), j) for x, j in want]
