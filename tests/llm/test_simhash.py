from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from renewline.llm import simhash
from renewline.llm.components import connected_components
from tests.llm import data


def plain_fingerprint(text: str | None) -> int:
    words = [bytes(w) for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], ids: list[int | None]) -> list[int | None]:
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least: dict[int, int | None] = {}
    for g, i in zip(group, ids):
        least[g] = min([x for x in (least.get(g), i) if x is not None], default=None)
    return [least[g] for g in group]


def near(rng: random.Random, base: int, bits: int) -> int:
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_fingerprint_matches_its_definition():
    for text in data.odd_texts()[:7] + [data.prose(s, n) for s, n in enumerate([1, 2, 3, 4, 5, 6, 70])]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    long = data.prose(3, 70_000)
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def signed(values):
    return np.array(values, np.uint64).view(np.int64).tolist()


@pytest.mark.parametrize("shard_rows", [50_000, 30])
def test_links_connect_the_same_sets(spark, shard_rows):
    rng = random.Random(shard_rows)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0}
    for _ in range(60):
        fps.add(near(rng, rng.choice(sorted(fps)), rng.randint(1, 6)))
    for centre in (0, rng.getrandbits(64)):
        fps |= {near(rng, centre, rng.randint(1, 3)) for _ in range(150)}
    fps = sorted(fps)
    points = spark.createDataFrame([(f,) for f in signed(fps)], "fp long")
    links = simhash.links(points, 4, shard_rows).collect()
    ids = {f: i for i, f in enumerate(signed(fps))}
    group = list(range(len(fps)))
    for r in links:
        a, b = group[ids[r.a]], group[ids[r.b]]
        group = [min(a, b) if g in (a, b) else g for g in group]
    expected = plain_components(fps, list(range(len(fps))))
    assert [expected[i] == expected[j] for i in range(len(fps)) for j in range(i)] == [
        group[i] == group[j] for i in range(len(fps)) for j in range(i)
    ]


def test_tree_prunes_and_finds_all():
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(700)]
    points = np.unique(np.array(base + [near(rng, b, 4) for b in base[:300]], np.uint64))
    a, b = simhash.tree_links(points, 4)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    direct = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    pairs = {frozenset(p) for p in np.argwhere(direct).tolist() if p[0] != p[1]}
    assert pairs <= found


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (None, 3)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = data.odd_texts() + [data.prose(90, 60)] * 12
    for _ in range(20):
        words = data.prose(rng.randint(0, 5), 300).split()
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    return out


def test_query(spark, tmp_path, texts):
    docs = data.documents(spark, texts)
    folder = data.parquet(docs, tmp_path)
    plain = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in plain]
    components = plain_components(fps, [r.doc_id for r in plain])
    expected = sorted((str(r.doc_id), f"{f:016x}", c) for r, f, c in zip(plain, fps, components))
    rows = simhash.op5_simhash_dedup(spark, folder).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == expected


def test_keep_one_keeps_one_row_of_each_group(spark, texts):
    docs = data.documents(spark, texts).withColumn("text", F.coalesce("text", F.lit("")))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    plain = docs.select("doc_id", "text").collect()
    components = plain_components([plain_fingerprint(r.text) for r in plain], [r.doc_id for r in plain])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(components))


def test_keep_one_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == ["a b c d", "x y z"]


def test_empty_table(spark, tmp_path):
    folder = data.parquet(data.documents(spark, []), tmp_path)
    assert simhash.op5_simhash_dedup(spark, folder).count() == 0
