"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import datetime
import os
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert entry.own_queries().keys() == entry.own_sql().keys()


@pytest.mark.parametrize("name", entry.own_queries())
def test_query_equals_sql(spark, duck, name):
    result = entry.own_queries()[name](spark, DATA)
    columns = sorted(result.columns)
    expected = duck.execute(entry.own_sql()[name])
    described = {c[0]: str(c[1]) for c in expected.description}
    assert sorted(described) == columns
    kinds = {f.name: f.dataType.simpleString() for f in result.schema}
    for column, kind in kinds.items():
        want = TYPES.get(kind, kind.upper())
        assert described[column].replace(" ", "") == want, column
    names = [c[0] for c in expected.description]
    order = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    got = Counter(tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect())
    assert sum(got.values()) > 0
    assert got == want
    values = {type(v) for row in got for v in row}
    assert values <= {int, str, datetime.date, Decimal, type(None)}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
