"""Registered queries against their SQL twins, and rows of those without one."""

from __future__ import annotations

import duckdb
import pytest

from meterline.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import FOLDER


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    ours = QUERIES[name](spark, FOLDER)
    columns = sorted(ours.columns)
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in ours.select(*columns).collect()), key=key) == sorted(theirs, key=key)
