"""Queries against their SQL twins on tables whose keys and URLs look as in larger ones."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from lockscope.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: Pages again under other ids, with the same URLs; part and supplier keys as of a hundred times the table.
GROWN = {
    "pages": "SELECT * REPLACE (page_id + i * 100003 AS page_id) FROM pages, range(6) r(i)",
    "lineitem": """SELECT * REPLACE (l_partkey + (l_partkey * 7 + l_suppkey) % 6 * 50000 AS l_partkey,
                                     l_suppkey + (l_suppkey * 3 + l_partkey) % 6 * 1000 AS l_suppkey) FROM lineitem""",
}
QUERY_NAMES = ["cache_coverage", "first_roots", "index_lines", "url_ladder"]


@pytest.fixture(scope="module")
def grown(tmp_path_factory):
    folder = tmp_path_factory.mktemp("grown")
    connection = duckdb.connect()
    for table, sql in GROWN.items():
        path = f"{folder}/{table}.parquet"
        source = f"'{SF_DIR}/{table}.parquet'"
        connection.execute(f"COPY ({sql.replace(f'FROM {table}', f'FROM {source}')}) TO '{path}' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    for file in set(os.listdir(SF_DIR)) - {f"{t}.parquet" for t in GROWN}:
        os.symlink(f"{SF_DIR}/{file}", f"{folder}/{file}")
    yield str(folder), connection
    connection.close()


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_on_grown_tables(spark, grown, name):
    folder, sql = grown
    cursor = sql.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = Counter(cursor.fetchall())
    assert expected
    assert Counter(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect()) == expected
