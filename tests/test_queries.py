"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from lockscope.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, (float, Decimal)):
        return int(value) if value == int(value) else float(f"{value:.9g}")
    return value


def bag(rows, columns):
    return Counter(tuple(plain(row[c]) for c in columns) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = sql.execute(ORACLES[name])
    columns = sorted(d[0] for d in cursor.description)
    expected = [dict(zip([d[0] for d in cursor.description], row)) for row in cursor.fetchall()]
    assert sorted(df.columns) == columns
    rows = [r.asDict() for r in df.collect()]
    assert rows
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r.values())
    assert bag(rows, columns) == bag(expected, columns)
