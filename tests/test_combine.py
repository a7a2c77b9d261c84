"""Combine functions of the user's own against plain loops and the column forms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import make_rides
from meterline import constants as K
from meterline.operators import combine as C
from meterline.operators import elementwise as E
from meterline.plans import jobs

SUM = C.Combine(("x",), "n bigint, total bigint", "n bigint, total bigint", lambda: (0, 0), lambda a, r: (a[0] + 1, a[1] + r[0]), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a: a)


def test_a_hot_key_is_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 3)  # many accumulators per task
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "", "c d"]), rng.randrange(-50, 50)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, x bigint").repartition(40)
    want = {}
    for k, x in rows:
        n, total = want.get(k, (0, 0))
        want[k] = (n + 1, total + x)
    for levels, fan in [(1, 4), (2, 4), (3, 3), (2, 32)]:
        assert {r.k: (r.n, r.total) for r in C.combine(df, ["k"], SUM, levels, fan).collect()} == want
    parts = C.partials(df, ["k"], SUM)
    assert parts.filter("k = 'hot'").count() == 40  # one of each task


def test_without_keys_and_without_rows(spark):
    df = spark.range(100).select(F.col("id").alias("x"))
    assert [tuple(r) for r in C.combine(df.repartition(7), [], SUM).collect()] == [(100, 4950)]
    assert C.combine(df.filter("x < 0"), [], SUM).collect() == []
    assert C.combine(df.filter("x < 0").withColumn("k", F.lit(1)), ["k"], SUM).collect() == []
    with pytest.raises(ValueError, match="floating"):
        C.combine(df.withColumn("k", F.lit(1.5)), ["k"], SUM)


def _rides(spark, seed=3, n=500):
    rng = random.Random(seed)
    return make_rides(spark, [
        {"t": rng.randrange(0, 4000 * 4) / 4, "ride_id": rng.choice(["hot", "hot", "a", "b"]), "message_id": i, "payload": rng.randrange(40) * 100,
         "status": rng.choice(["pickup", "enroute", "dropoff"]), "latitude": 40 + rng.random()} for i in range(n)
    ]).repartition(6)


@pytest.mark.parametrize("gap_s", [5, 60, 3600])
def test_sessions_of_a_combine_function_equal_the_column_form(spark, gap_s):
    points = E.ride_points(_rides(spark))
    gap = gap_s * K.SECOND_US
    columns = ["ride_id", "session_start_us", "session_end_us", "message_id", "ts_ms"]
    pairs = [
        (C.combine_sessions(points, gap, C.latest_point()), jobs.latest_points(points, gap)),
        (C.combine_sessions(points, gap, C.pickup_point()).filter("ride_status is not null"), jobs.pickup_points(points, gap)),
    ]
    for ours, theirs in pairs:
        assert sorted(ours.select(*columns).collect()) == sorted(theirs.select(*columns).collect())


def test_totals_keep_nulls_and_cents(spark):
    df = spark.createDataFrame([("a", 0.1, 3), ("a", 0.2, None), ("a", None, 1), ("b", None, None)], "ride_id string, meter_increment double, passenger_count int")
    got = {r[0]: tuple(r)[1:] for r in C.combine(df, ["ride_id"], C.ride_totals()).collect()}
    assert got == {"a": (3, 0.3, 1, 3), "b": (1, 0.0, None, None)}
