"""The registered queries against their SQL, at the smallest scale."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from renewline.llm import queries
from tests.llm import data
from tests.llm.test_secrets import texts

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}


def compare(spark, folder, name, pattern):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        if os.path.exists(f"{folder}/{table}.parquet"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet{pattern}'")
    result = queries.QUERIES[name](spark, folder)
    expected = duck.execute(queries.ORACLE_SQL[name])
    described = {c[0]: str(c[1]) for c in expected.description}
    assert described == {f.name: KINDS[f.dataType.simpleString()] for f in result.schema}
    names = [c[0] for c in expected.description]
    rows = expected.fetchall()
    got = Counter(tuple(r) for r in result.select(*names).collect())
    assert sum(got.values()) == len(rows)
    assert got == Counter(rows)


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    compare(spark, DATA, name, "")


@pytest.mark.parametrize("name", [n for n in queries.ORACLE_SQL if n != "op13_hard_negatives"])
def test_odd_texts(spark, tmp_path, name):
    odd = [t for t in texts() if not t or len(t) < 20_000 and "ſ" not in t]
    folder = data.parquet(data.documents(spark, odd), tmp_path)
    compare(spark, folder, name, "/*.parquet")


@pytest.mark.parametrize("name", ["op2_hilbert_shards", "op4_length_buckets"])
def test_many_rows_in_parts(spark, tmp_path, name):
    rows = spark.range(12_000).selectExpr(
        "id AS doc_id", "concat('text ', repeat('w ', cast(id % 9 AS int))) AS text", "'en' AS lang",
        "'s' AS source", "id AS n_chars",
    )
    folder = data.parquet(rows, tmp_path)
    compare(spark, folder, name, "/*.parquet")
