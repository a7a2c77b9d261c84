from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import make_rides, us
from meterline import constants as K
from meterline.operators.sessions import session_spans
from meterline.operators import aggs, lateness, trails
from meterline.plans import jobs


def _spans(rows, gap_us):
    out = []
    by = {}
    for r in rows:
        by.setdefault(r["ride_id"], []).append(us(r["t"]))
    for ride, times in by.items():
        times.sort()
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if t - last >= gap_us:
                out.append((ride, start, last + gap_us, n))
                start, n = t, 0
            last, n = t, n + 1
        out.append((ride, start, last + gap_us, n))
    return sorted(out)


def test_exactly_one_gap_apart_starts_a_new_session(spark):
    rows = [{"t": 0}, {"t": 60}, {"t": 119.999999}]
    got = session_spans(make_rides(spark, rows), K.PICKUP_GAP_US).orderBy("session_start_us").collect()
    assert [(r.session_start_us, r.n_points) for r in got] == [(us(0), 1), (us(60), 2)]


def test_sessions_equal_a_loop_with_a_hot_ride(spark):
    rnd = random.Random(5)
    rows = [{"ride_id": rnd.choice(["hot", "hot", "a", "b", "c"]), "t": rnd.randint(0, 40_000) / 2} for _ in range(900)]
    df = make_rides(spark, rows).repartition(5)
    for gap in (K.SECOND_US * 30, K.MINUTE_US):
        got = sorted(tuple(r) for r in session_spans(df, gap).collect())
        assert got == _spans(rows, gap)


def test_latest_follows_payload_time_and_smallest_id_on_ties(spark):
    rows = [
        {"t": 0, "payload": 50, "message_id": 1},
        {"t": 10, "payload": 70.0004, "message_id": 9},
        {"t": 20, "payload": 70.0009, "message_id": 4},  # the same ms as the row before
        {"t": 30, "payload": 60, "message_id": 5},
    ]
    (row,) = jobs.latest_points(make_rides(spark, rows)).collect()
    assert (row.message_id, row.session_start_us, row.session_end_us) == (4, us(0), us(30) + K.LATEST_GAP_US)


def test_pickups_are_not_filtered_before_the_sessions(spark):
    rows = [
        {"t": 0, "status": "pickup", "message_id": 1},
        {"t": 45, "message_id": 2},
        {"t": 90, "status": "pickup", "message_id": 3},
        {"t": 400, "message_id": 4},
    ]
    (row,) = jobs.pickup_points(make_rides(spark, rows)).collect()
    assert (row.message_id, row.session_start_us, row.session_end_us) == (1, us(0), us(150))


def test_row_order_does_not_matter(spark):
    rnd = random.Random(7)
    rows = [
        {"ride_id": rnd.choice("ab"), "t": rnd.randint(0, 3000), "payload": rnd.randint(0, 3000), "message_id": i,
         "status": rnd.choice(["pickup", "enroute", "dropoff"])}
        for i in range(300)
    ]
    df = make_rides(spark, rows)
    shuffled = df.orderBy(F.rand(3)).repartition(6)
    for job in (jobs.latest_points, jobs.pickup_points, jobs.count_cells, jobs.run_rate, jobs.exact_turnover):
        assert sorted(map(tuple, job(df).collect())) == sorted(map(tuple, job(shuffled).collect()))


def test_one_latest_point_per_session(spark):
    rnd = random.Random(8)
    df = make_rides(spark, [{"ride_id": rnd.choice("abc"), "t": rnd.randint(0, 9000), "message_id": i} for i in range(400)])
    assert jobs.latest_points(df, K.MINUTE_US).count() == session_spans(df, K.MINUTE_US).count()


def test_rows_of_closed_sessions_are_late(spark):
    rows = [{"t": t, "message_id": i, "arrival_ms": a} for i, (t, a) in enumerate([(0, 0), (100, 100), (30, 200), (41, 201), (150, 300)])]
    kept = lateness.in_time(make_rides(spark, rows), K.MINUTE_US)
    # the watermark is 100 s when the late rows come: 30 + 60 is behind it, 41 + 60 is not
    assert sorted(r.message_id for r in kept.collect()) == [0, 1, 3, 4]


def test_slots_before_the_epoch(spark):
    df = spark.createDataFrame([("a", -35_000_000), ("a", 35_000_000)], "ride_id string, event_us bigint")
    spans = sorted(tuple(r) for r in session_spans(df, K.MINUTE_US).collect())
    assert [s[1:] for s in spans] == [(-35_000_000, 25_000_000, 1), (35_000_000, 95_000_000, 1)]
    batches = trails.with_batch(spark.createDataFrame([(-1,), (0,)], "arrival_ms bigint"))
    assert sorted(r.batch_id for r in batches.collect()) == [-1, 0]


def test_latest_and_first_matching_value_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, "enroute"), ("a", 2, 30, "pickup"), ("a", 3, 30, "pickup"), ("b", 4, 5, "enroute")],
        "ride_id string, message_id bigint, ts_ms bigint, ride_status string",
    )
    newest = aggs.latest_by(df, ["ride_id"], F.col("message_id"), aggs.newest_first())
    assert sorted(tuple(r) for r in newest.collect()) == [("a", 2), ("b", 4)]
    pickup = F.col("ride_status") == K.STATUS_PICKUP
    first = aggs.first_matching_by(df, ["ride_id"], F.col("message_id"), pickup, aggs.oldest_first())
    assert sorted(tuple(r) for r in first.collect()) == [("a", 2), ("b", None)]
