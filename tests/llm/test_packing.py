from __future__ import annotations

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from renewline.llm import packing
from tests.llm import data


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(0, 12), rng.randint(0, 60)]) for _ in range(40)]
    distinct = sorted(set(lengths))
    bins = [(n, lengths.count(n), n * lengths.count(n)) for n in distinct]
    for buckets in (1, 2, 3):
        found = packing.boundaries(bins, buckets)
        best = min(
            padding(lengths, (*c, distinct[-1]))
            for c in itertools.combinations(distinct[:-1], min(buckets, len(distinct)) - 1)
        )
        assert len(found) <= buckets and padding(lengths, found) == best


def test_no_more_buckets_than_lengths():
    assert packing.boundaries([(3, 2, 6), (9, 1, 9)], 16) == [3, 9]
    assert packing.boundaries([], 4) == []


def test_histogram_is_bounded_and_exact_in_sum(spark):
    lengths = spark.range(60_000).select((F.col("id") * 37).cast("int").alias("n_tokens"))
    bins = packing.histogram(lengths)
    assert len(bins) <= 2_048 + 1_024 * 12
    assert sum(b[1] for b in bins) == 60_000
    assert sum(b[2] for b in bins) == 37 * 59_999 * 30_000


def test_batches(spark, tmp_path):
    texts = data.odd_texts() * 20
    folder = data.parquet(data.documents(spark, texts), tmp_path)
    rows = packing.op4_length_buckets(spark, folder).collect()
    assert len(rows) == len(texts) + 3
    batches = defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            plain = (texts[r.doc_id] or "").encode().split()
            assert r.n_tokens == len(plain)
        assert r.padding == r.bucket_len - r.n_tokens >= 0
        batches[r.bucket, r.batch].append(r)
    for (bucket, _), members in batches.items():
        assert sorted(m.slot for m in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].bucket_len <= packing.BUDGET
    for bucket in {b for b, _ in batches}:
        assert sorted(n for b, n in batches if b == bucket) == list(range(sum(b == bucket for b, _ in batches)))


def test_empty_table(spark, tmp_path):
    assert packing.op4_length_buckets(spark, data.parquet(data.documents(spark, []), tmp_path)).count() == 0


def test_hot_bucket_is_numbered_in_parts(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = packing.pack(docs, rows_per_task=100, budget=30).collect()
    assert len({(r.batch, r.slot) for r in rows}) == 3_000 and max(r.batch for r in rows) == 299
