"""Every registered query against its SQL twin on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from meterline.plans.catalog import QUERIES
from meterline.plans.oracles import ORACLES

SF = "/root/testdata/sf0.01"
TABLES = "events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        values = []
        for i in order:
            v = row[i]
            if isinstance(v, float) and math.isnan(v):
                v = None
            values.append(v)
        out.append(tuple(values))
    return sorted(out, key=lambda r: [(v is None, str(type(v)) if isinstance(v, str) else "", v if v is not None else 0) for v in r])


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = entry_point.queries()[name](spark, SF)
    theirs = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _rows(columns, theirs.fetchall())
    got = _rows(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(got) == len(expected)
    assert got == expected


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
