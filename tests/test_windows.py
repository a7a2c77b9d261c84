from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import make_rides, us
from meterline.plans import jobs
from meterline.operators import lateness as L


def test_a_row_on_the_edge_belongs_to_the_later_window(spark):
    rows = [{"t": 0.999999}, {"t": 1.0}, {"t": 1.5, "payload": 9.2504}]
    got = {r.window_start_us: (r.max_ts_ms, r.timestamp) for r in jobs.max_timestamp(make_rides(spark, rows)).collect()}
    assert got == {
        us(0): (us(0.999) // 1000, "2024-01-01T00:00:00.999Z"),
        us(1): (us(9.25) // 1000, "2024-01-01T00:00:09.250Z"),
    }


def test_every_row_is_in_twenty_sliding_windows_and_both_forms_agree(spark):
    rnd = random.Random(1)
    rows = [{"t": rnd.randint(0, 600_000_000) / 1e6, "amount": rnd.randint(1, 9999) / 100} for _ in range(300)]
    df = make_rides(spark, rows)
    two, one = jobs.run_rate(df), jobs.run_rate(df, two_stage=False)
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))
    total = two.agg(F.sum("dollar_run_rate_per_minute")).first()[0]
    assert round(total, 4) == round(20 * sum(r["amount"] for r in rows), 4)


def test_cell_counts_add_up_to_the_rows(spark):
    rnd = random.Random(2)
    rows = [{"t": rnd.randint(0, 50), "latitude": rnd.uniform(40, 41), "longitude": rnd.uniform(-75, -73)} for _ in range(500)]
    assert jobs.count_cells(make_rides(spark, rows), edge=0.5).agg(F.sum("ntaxis")).first()[0] == 500


def test_empty_windows_give_no_row(spark):
    rows = [{"t": 0}, {"t": 300}]
    assert jobs.window_turnover(make_rides(spark, rows)).count() == 2


def _classes(rows):
    """Per row: on time, late or dropped, by the greatest event time of earlier arrival ms."""
    out = {}
    for i, r in enumerate(rows):
        seen = [us(o["t"]) for o in rows if o["arrival_ms"] < r["arrival_ms"]]
        end = us(r["t"]) // 60_000_000 * 60_000_000 + 60_000_000
        if not seen or end > max(seen):
            out[i] = "ON_TIME"
        else:
            out[i] = "LATE" if end + 300_000_000 > max(seen) else "DROPPED"
    return out


def test_lateness_classes_equal_a_loop(spark):
    rnd = random.Random(4)
    rows = [{"t": rnd.randint(0, 1500), "amount": 1.25} for _ in range(400)]
    for r in rows:
        r["arrival_ms"] = us(r["t"]) // 1000 + rnd.choice([0, 0, 0, rnd.randint(0, 500_000)])
    df = make_rides(spark, rows)
    want = _classes(rows)
    got = {r.message_id: r.lateness for r in L.classify_rows(df).collect()}
    assert got == want and set(want.values()) == {"ON_TIME", "LATE", "DROPPED"}
    final = {r.window_start_us: r.n_points for r in jobs.exact_turnover(df).collect()}
    kept = {}
    for i, r in enumerate(rows):
        if want[i] != "DROPPED":
            start = us(r["t"]) // 60_000_000 * 60_000_000
            kept[start] = kept.get(start, 0) + 1
    assert final == kept


def test_panes_accumulate_and_a_late_only_window_has_no_on_time_pane(spark):
    rows = [
        {"t": 10, "amount": 1, "arrival_ms": 1}, {"t": 200, "amount": 2, "arrival_ms": 2},
        {"t": 20, "amount": 4, "arrival_ms": 3}, {"t": 130, "amount": 8, "arrival_ms": 4},
        {"t": 30, "amount": 16, "arrival_ms": 5}, {"t": 500, "amount": 32, "arrival_ms": 6},
        {"t": 40, "amount": 64, "arrival_ms": 7},
    ]
    panes = jobs.turnover_panes(make_rides(spark, rows)).orderBy("window_start_us", "pane_order").collect()
    got = [((r.window_start_us - us(0)) // 1_000_000, r.dollar_timing, r.dollar_turnover) for r in panes]
    assert got == [
        (0, "ON_TIME", 1.0), (0, "LATE", 5.0), (0, "LATE", 21.0), (120, "LATE", 8.0), (180, "ON_TIME", 2.0), (480, "ON_TIME", 32.0),
    ]
