from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.functions import scalars as S
from meterline.operators import elementwise as E


def _one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


def test_grid_cell_is_single_precision_throughout(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in rng.uniform(-180, 180, 3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", S.grid_cell(F.col("x")).alias("y"))
    edge = np.float32(0.005)
    for row in df.collect():
        x = np.float32(row.x)
        cell = np.float32(np.floor(np.float32(x / edge))) * edge + edge / np.float32(2)
        assert row.y == float(np.float32(cell))


@pytest.mark.parametrize(
    "text, ms",
    [
        ("2019-03-05T07:08:09.123456789+02:00", 1551762489123),
        ("2016-08-31T15:04:02Z", 1472655842000),
        ("2016-08-31T15:04:02.999999Z", 1472655842999),
        ("2016-08-31T15:04:02", None),
        ("2016-08-31", None),
        ("soon", None),
    ],
)
def test_iso_to_ms(spark, text, ms):
    assert _one(spark, S.iso_to_ms, text, "string") == ms


@pytest.mark.parametrize(
    "ms, text",
    [(1472655842025, "2016-08-31T15:04:02.025Z"), (1472655842000, "2016-08-31T15:04:02Z"), (0, "1970-01-01T00:00:00Z")],
)
def test_ms_to_iso(spark, ms, text):
    assert _one(spark, S.ms_to_iso, ms, "bigint") == text


@pytest.mark.parametrize("x, text", [(1234.5, "$1,234.50"), (-0.25, "-$0.25"), (0.0, "$0.00"), (1e6, "$1,000,000.00"), (0.125, "$0.13"), (2.125, "$2.13"), (-2.125, "-$2.13"), (2.675, "$2.68"), (0.124, "$0.12")])
def test_us_currency(spark, x, text):
    assert _one(spark, S.us_currency, x, "double") == text


@pytest.mark.parametrize("x, y", [(2.5, 3), (-2.5, -2), (0.49, 0), (1.0, 1)])
def test_round_half_up(spark, x, y):
    assert _one(spark, S.round_half_up, x, "double") == y


def test_group_decay_equals_a_loop(spark):
    rows = [(w, n) for w in (0, 1, 5, 35, 100, 12345, 2**60) for n in (0, 1, 2, 7, 40, 255, 256, 5000)]
    df = spark.createDataFrame(rows, "w bigint, n bigint")
    for row in df.select("w", "n", S.group_decay(F.col("w"), F.col("n")).alias("y")).collect():
        w = row.w
        for _ in range(row.n):
            w = 4 * w // 5
        assert row.y == w, row


def test_money_is_exact_in_any_order(spark):
    rng = np.random.default_rng(2)
    cents = [int(c) for c in rng.integers(-10**6, 10**6, 5000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(7)
    out = df.agg(S.money_value(F.sum(S.money_hi(F.col("x"))), F.sum(S.money_lo(F.col("x")))).alias("y")).first().y
    assert out == sum(cents) / 100


def test_box_limits_are_strict_and_in_single_precision(spark):
    rows = [
        (1, 40.71, -74.0), (2, 40.699, -74.0), (3, 40.72, -74.0), (4, 40.71, -74.747), (5, 40.71, -73.969),
        (6, 40.6990001, -74.0), (7, 40.6989, -74.0), (8, None, -74.0),
    ]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    got = {r.id for r in E.box_filter(df).collect()}
    want = set()
    for i, lat, lon in rows:
        if lat is None:
            continue
        la, lo = float(np.float32(lat)), float(np.float32(lon))
        if 40.699 < la < 40.720 and -74.747 < lo < -73.969:
            want.add(i)
    assert got == want


def test_flat_map_can_give_none_or_many(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    out = E.flat_map_rows(df, lambda row: F.when(row.n > 0, F.array_repeat(row, row.n)).otherwise(F.array().cast("array<struct<n:int>>")))
    assert sorted(r.n for r in out.collect()) == [1, 3, 3, 3]


@pytest.mark.parametrize("x, y", [(-35, -1), (35, 0), (-60, -1), (-61, -2), (60, 1), (0, 0)])
def test_floor_division_below_zero(spark, x, y):
    assert _one(spark, lambda c: S.floor_div(c, 60), x, "bigint") == y


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", "1e10", "-1e300", "x", None])
def test_odd_amounts_are_no_amounts_and_throw_nothing(spark, text):
    assert _one(spark, S.amount, text, "string") is None
    assert _one(spark, lambda c: S.money_hi(S.amount(c)), text, "string") is None
    _one(spark, S.money_lo, text, "string")
