from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from renewline.llm import sharding
from tests.llm import data


def curve_point(index: int, dims: int, bits: int) -> tuple[int, ...]:
    """The cell at a place of the curve, by the inverse walk: Gray code, then rotations undone."""
    x = [0] * dims
    for at in range(bits * dims):
        bit = index >> (bits * dims - 1 - at) & 1
        x[at % dims] |= bit << (bits - 1 - at // dims)
    t = x[-1] >> 1
    for i in range(dims - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= t
    q = 2
    while q != 1 << bits:
        p = q - 1
        for i in range(dims - 1, -1, -1):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q <<= 1
    return tuple(x)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_index_walks_the_curve(spark, dims, bits):
    cells = [curve_point(i, dims, bits) for i in range(1 << dims * bits)]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(cells, cells[1:]))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i long, " + ", ".join(f"x{k} int" for k in range(dims)))
    index = sharding.hilbert_index([F.col(f"x{k}") for k in range(dims)], bits)
    assert df.where(index != F.col("i")).count() == 0


def check(rows, texts_by_id):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values(), default=0) - min((counts.get(k, 0) for k in range(8)), default=0) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert all(a.hilbert <= b.hilbert for a, b in zip(ordered, ordered[1:]))
    for r in rows:
        assert (r.law, r.grown_shard) == ("rows", None)
        if r.doc_id is not None:
            raw = (texts_by_id[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


@pytest.mark.parametrize("count", [0, 3, 400])
def test_shards(spark, tmp_path, count):
    texts = (data.odd_texts() * 40)[:count]
    folder = data.parquet(data.documents(spark, texts), tmp_path)
    rows = sharding.op2_hilbert_shards(spark, folder).collect()
    assert len(rows) == (count + 3 if count else 0)
    check(rows, dict(enumerate(texts)))


def test_one_cell_holds_all_rows(spark):
    rows = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("h"))
    found = sharding.shard_by_curve(rows, "h", ["doc_id"], rows_per_task=100).collect()
    assert Counter(r.shard for r in found) == {k: 625 for k in range(8)}
    assert len({(r.shard, r.slot) for r in found}) == 5_000


def test_written_shards_keep_their_rows(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 9).alias("h"))
    sharding.write_shards(sharding.shard_by_curve(rows, "h", ["doc_id"]), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").select("doc_id").distinct().count() == 100


def test_parts_follow_the_rows_of_a_cell(spark):
    """One cell holds most rows: it alone is cut, so a window over parts sees few rows."""
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id < 29000, 7, id) % 4096 AS cell", "id % 3 AS row", "id AS part")
    rows = sharding.shard_by_curve(rows, "cell", ["doc_id"], rows_per_task=1_000, coarse_bits=2, index_bits=12)
    got = rows.collect()
    assert rows.columns == ["doc_id", "cell", "row", "part", "slot", "shard"]
    assert sorted((r.shard, r.slot) for r in got) == [(k, n) for k in range(8) for n in range(3_750)]
    assert all(r.part == r.doc_id and r.row == r.doc_id % 3 for r in got)
    plan = rows._jdf.queryExecution().executedPlan()
    counted = rows.groupBy("cell").count().count()
    assert counted < 1_100 and "Window" in plan.toString()
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.cell for r in ordered] == sorted(r.cell for r in got)
