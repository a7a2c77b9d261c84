"""Running and sliding aggregates against plain loops, with levels and blocks small enough to matter."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meterline.operators.scan import exclusive_scan, last_n, ring_statistics, running_count


@pytest.mark.parametrize("cut_input", [True, False])
def test_exclusive_scan(spark, cut_input):
    rnd = random.Random(3)
    keys = sorted(rnd.sample(range(5000), 700))
    rows = [(k % 3 == 0 and "x" or "y", k // 500, k // 50, k, rnd.randint(-9, 9)) for k in keys]
    df = spark.createDataFrame(rows, "p string, a bigint, b bigint, k bigint, v bigint")
    out = exclusive_scan(df, ["p"], ["a", "b", "k"], {"s": ("sum", "v"), "m": ("max", "v")}, cut_input)
    got = {(r.p, r.k): (r.s, r.m) for r in out.collect()}
    assert len(got) == len(rows)
    for p in "xy":
        seen = []
        for q, _a, _b, k, v in rows:
            if q == p:
                assert got[(p, k)] == (sum(seen), max(seen) if seen else None)
                seen.append(v)


def test_running_count_of_one_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("p"), "id")
    df = df.withColumn("b", F.shiftright("id", 6))
    got = running_count(df, ["p"], ["b", "id"], "n").orderBy("id").collect()
    count = {"hot": 0, "cold": 0}
    for row in got:
        assert row.n == count[row.p]
        count[row.p] += 1


@pytest.mark.parametrize("n", [1, 2, 15, 64, 100])
def test_last_n_over_block_borders(spark, n):
    rnd = random.Random(n)
    values = [rnd.randint(-50, 50) for _ in range(333)]
    rows = [("p", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "p string, i bigint, v bigint")
    out = last_n(df, ["p"], "i", n, sums={"s": "v"}, mins={"lo": "v"}, maxs={"hi": "v"}, firsts={"f": "v"}, block=32)
    got = {r.i: r for r in out.collect()}
    assert len(got) == len(values)
    for i in range(len(values)):
        frame = values[max(0, i - n + 1) : i + 1]
        r = got[i]
        assert (r.rows_in_frame, r.s, r.lo, r.hi, r.f) == (len(frame), sum(frame), min(frame), max(frame), frame[0])


def test_ring_statistics_of_one_value(spark):
    df = spark.createDataFrame([("p", 0, 7)], "p string, i bigint, v bigint")
    r = ring_statistics(df, ["p"], "i", "v", 15).first()
    assert (r.ring_sum, r.ring_avg, r.ring_min, r.ring_max, r.ring_span) == (7, 7.0, 7, 7, 0)
