"""The physical plans keep the properties the design rests on."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from conftest import make_rides
from meterline.operators import trails
from meterline.plans import jobs
from meterline.plans.catalog import QUERIES
from meterline.sources import rides as R

SMALL = "/root/testdata/sf0.001"
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_rows(spark, name):
    plan = _plan(entry_point.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "BatchEvalPython"):
        assert bad not in plan


def test_the_box_reaches_the_file_scan(spark, tmp_path):
    make_rides(spark, [{"t": 0}]).write.parquet(str(tmp_path / "rides"))
    plan = _plan(jobs.filter_box(spark.read.parquet(str(tmp_path / "rides"))).select("ride_id", "latitude", "longitude"))
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(latitude" in pushed  # the text form of the list is cut short
    assert "ReadSchema: struct<ride_id:string,latitude:double,longitude:double>" in plan


def test_the_prefix_reaches_the_file_scan(spark, tmp_path):
    make_rides(spark, [{"t": 0}]).write.parquet(str(tmp_path / "rides"))
    assert "StringStartsWith(ride_id,ab)" in _plan(jobs.filter_prefix(spark.read.parquet(str(tmp_path / "rides"))))


def test_trail_ranks_are_limited_before_the_shuffle(spark):
    rides = trails.with_batch(R.load_rides(spark, SMALL))
    plan = _plan(trails.ride_trails(rides))
    assert "WindowGroupLimit" in plan and "Partial" in plan[plan.index("WindowGroupLimit") :]


def test_counts_are_reduced_before_the_shuffle(spark):
    plan = _plan(jobs.count_cells(R.load_rides(spark, SMALL)))
    assert plan.index("Exchange") < plan.index("partial_count")


@pytest.mark.parametrize("name", ["flag_duplicates", "duplicates_per_batch", "feed_health"])
def test_deliveries_are_reduced_once(spark, name):
    # everything above the one written reduction reads that table, never the deliveries again
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "events.parquet" not in plan
    assert plan.count("Exchange") <= 24
