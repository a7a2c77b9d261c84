from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import make_rides, us
from meterline import constants as K
from meterline.operators import duplicates, feed, trails
from meterline.operators.joins import salted_join
from meterline.sources import rides as R


# --- duplicates -------------------------------------------------------------------

def _greedy(arrivals, memory):
    """{(id, ms): (copies, duplicates)} by walking the arrivals of each id."""
    out, first = {}, {}
    for key, ms in sorted(arrivals, key=lambda a: (a[0], a[1])):
        copies, dups = out.get((key, ms), (0, 0))
        if key in first and ms - first[key] <= memory:
            dups += 1
        else:
            first[key] = ms
        out[(key, ms)] = (copies + 1, dups)
    return out


def _check(spark, arrivals, memory):
    df = spark.createDataFrame(arrivals, "message_id bigint, arrival_ms bigint").repartition(5)
    got = {(r.message_id, r.arrival_ms): (r.copies, r.duplicates) for r in duplicates.duplicate_counts(df, memory_ms=memory).collect()}
    assert got == _greedy(arrivals, memory)


def test_duplicates_memory_edges(spark):
    _check(spark, [(1, 0), (1, 30_000), (1, 30_001), (1, 60_001), (1, 60_002), (2, 5), (2, 5), (2, 5)], 30_000)


@pytest.mark.parametrize("seed, span, n, memory", [(1, 2000, 400, 30), (2, 300, 500, 7), (3, 100_000, 300, 30_000), (4, 900, 900, 1)])
def test_duplicates_equal_a_loop(spark, seed, span, n, memory):
    rnd = random.Random(seed)
    # id 0 holds a third of all deliveries, without a pause as long as the memory
    arrivals = [(0 if i % 3 == 0 else rnd.randint(1, 12), rnd.randint(0, span)) for i in range(n)]
    _check(spark, arrivals, memory)


def test_a_long_unbroken_run(spark):
    _check(spark, [(7, ms) for ms in range(0, 3000, 3)] + [(8, 1)], 20)


def test_no_deliveries(spark):
    df = spark.createDataFrame([], "message_id bigint, arrival_ms bigint")
    assert duplicates.duplicate_counts(df).count() == 0


# --- trails and heat ----------------------------------------------------------------

def _walk(points, head=5):
    """Point set of the feed after all batches: {message_id: weight}."""
    held = {}
    for batch in sorted({b for _r, b, _m in points}):
        new = [(r, m) for r, b, m in points if b == batch]
        rides = {r for r, _m in new}
        for key in list(held):
            ride, _ = key
            if ride in rides:
                held[key] -= 1
                if held[key] <= 0:
                    del held[key]
        for r, m in new:
            held[(r, m)] = head
    return {m: w for (_r, m), w in held.items()}


def test_trails_equal_the_walk(spark):
    rnd = random.Random(11)
    points = [(rnd.choice(["hot", "hot", "a", "b"]), rnd.randint(0, 60), i) for i in range(300)]
    df = spark.createDataFrame(points, "ride_id string, batch_id bigint, message_id bigint")
    got = {r.message_id: r.weight for r in trails.ride_trails(df).collect()}
    assert got == _walk(points)


def test_merging_batches_one_by_one_gives_the_trails(spark):
    rnd = random.Random(12)
    points = [(rnd.choice(["x", "y", "z"]), rnd.randint(0, 6), i) for i in range(40)]
    schema = "ride_id string, batch_id bigint, message_id bigint"
    held = spark.createDataFrame([], schema + ", weight bigint")
    for batch in sorted({p[1] for p in points}):
        arrived = spark.createDataFrame([p for p in points if p[1] == batch], schema)
        held = spark.createDataFrame(trails.merge_batch(held, arrived).collect(), schema + ", weight bigint")
    assert {r.message_id: r.weight for r in held.collect()} == _walk(points)


def test_points_without_a_ride_stay(spark):
    held = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "ride_id string, message_id bigint")
    arrived = spark.createDataFrame([("a", 9)], "ride_id string, message_id bigint")
    assert {r.message_id for r in trails.updated_points(held, arrived).collect()} == {1}
    assert {r.message_id for r in trails.other_points(held, arrived).collect()} == {2, 3}


def _heat_walk(points, cells, as_of):
    """Tick through every 250 ms; batches arrive on ticks, before that tick fades older points."""
    held = []
    for now in range(0, as_of + 1, 250):
        weak = max([h["w"] for h in held], default=0) // 20
        arrived = [p for p in points if p["ms"] == now]
        rides = {p["ride"] for p in arrived}
        for h in held:
            if h["ride"] is None:
                if now - h["ms"] > 5000:
                    h["w"] = 4 * h["w"] // 5
                continue
            fade = h["w"] < 5 or now - h["ms"] > 5000
            if fade:
                h["w"] -= 1
            if h["ride"] in rides:
                h["w"] -= 1
        held = [h for h in held if h["w"] > weak]
        held += [{**p, "w": 5} for p in arrived]
        held += [{"ride": None, "id": c["id"], "ms": now, "w": 5 * c["n"]} for c in cells if c["ms"] == now]
    return held


def test_heat_equals_ticking(spark):
    rnd = random.Random(13)
    points = [{"ride": rnd.choice("abcd"), "id": i, "ms": rnd.randrange(0, 30_000, 250)} for i in range(60)]
    cells = [{"id": 1000 + i, "ms": rnd.randrange(0, 30_000, 250), "n": rnd.choice([1, 2, 9, 40, 300])} for i in range(25)]
    pdf = spark.createDataFrame(
        [(p["ride"], p["id"], p["ms"] // 250, 0.0, 0.0) for p in points],
        "ride_id string, message_id bigint, batch_id bigint, latitude double, longitude double",
    )
    cdf = spark.createDataFrame(
        [(float(c["id"]), 0.0, c["ms"], c["n"]) for c in cells], "latitude double, longitude double, arrival_ms bigint, ntaxis bigint"
    )
    every = 1000
    got = {}
    for r in trails.heat_weights(pdf, cdf, every).collect():
        key = r.message_id if r.ride_id is not None else int(r.latitude)
        got.setdefault(r.as_of_ms, {})[key] = r.weight
    for as_of in range(0, 40_000, every):
        want = {h["id"]: h["w"] for h in _heat_walk(points, cells, as_of)}
        assert got.get(as_of, {}) == want, as_of


def test_cull_weak(spark):
    df = spark.createDataFrame([(5,), (100,), (6,)], "weight bigint")
    assert sorted(r.weight for r in trails.cull_weak(df).collect()) == [6, 100]


# --- health, boards, routing ------------------------------------------------------------

def _health_walk(batches, pull, n=15):
    ring, out, before = [], [], None
    for batch_id, messages, dups in sorted(batches):
        ms = batch_id * 250
        ring = (ring + [(messages, ms, messages == pull, dups)])[-n:]
        span = (max(r[1] for r in ring) - min(r[1] for r in ring)) / 1000 or 1
        rate = int(sum(r[0] for r in ring) * 10 / span + 0.5) / 10
        rate = float(int(rate + 0.5)) if rate >= 1 else rate
        if rate == 0:
            status = "none"
        elif sum(r[3] for r in ring) > 0:
            status = "severe"
        elif sum(r[2] for r in ring) / len(ring) > 0.5:
            status = "overload"
        else:
            status = "ok"
        idle = None if before is None else ms - before
        out.append((batch_id, rate, idle, idle is None or idle > 6000, status))
        before = ms
    return out


def test_feed_health_equals_a_walk(spark):
    rnd = random.Random(21)
    for feed_id, (pull, dup_share) in {"f": (3, 0.0), "g": (1000, 0.02), "h": (2, 0.0)}.items():
        ids = sorted(rnd.sample(range(0, 40_000), 200))
        batches = [(b, rnd.choice([1, pull, pull]), int(rnd.random() < dup_share)) for b in ids]
        df = spark.createDataFrame([(feed_id, *b) for b in batches], "feed_id string, batch_id bigint, n_messages bigint, n_duplicates bigint")
        out = feed.feed_health(df, pull_size=pull).orderBy("batch_id").collect()
        got = [(r.batch_id, r.data_rate, r.idle_ms, r.was_silent, r.status) for r in out]
        assert got == _health_walk(batches, pull)


def test_health_now_goes_stale(spark):
    df = spark.createDataFrame([("f", 10, "ok"), ("f", 12, "severe")], "feed_id string, batch_id bigint, status string")
    assert feed.health_now(df, F.lit(3000 + 6000)).first().status == "severe"
    assert feed.health_now(df, F.lit(3000 + 6001)).first().status == "none"


def test_board_keeps_the_last_pane_and_names_its_state(spark):
    rows = [(1.0, 0, "EARLY", 5.0), (1.0, 7, "LATE", 9.5), (2.0, 0, "ON_TIME", 1234.0), (3.0, 0, "EARLY", 1.0)]
    df = spark.createDataFrame(rows, "dollar_window double, pane_order bigint, dollar_timing string, dollar_turnover double")
    got = {r.dollar_window: (r.state, r.text) for r in feed.turnover_board(df).collect()}
    assert got == {1.0: ("corrected", "(updated) $9.50"), 2.0: ("", " $1,234.00"), 3.0: ("incomplete", "(processing) $1.00")}


def test_routing_goes_by_key_presence(spark):
    texts = ['{"ride_id":"a","timestamp":"t"}', '{"ntaxis":3,"latitude":1}', '{"dollar_turnover":null}', '{"other":1}', '{"ride_id":null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    sealed = df.select("id", F.base64(F.col("text").cast("binary")).alias("data"))
    got = sorted((r.id, r.kind) for r in feed.route_messages(R.open_envelopes(sealed)).collect())
    assert got == [(0, "clock"), (0, "ride"), (1, "cell"), (2, "pane"), (4, "ride")]


def test_rejects_say_why(spark):
    good = '{"ride_id":"a","latitude":1.5,"longitude":"-2","timestamp":"2016-08-31T11:04:02Z","meter_increment":0.5,"ride_status":"pickup"}'
    texts = {
        good: None,
        good.replace('"latitude":1.5,', ""): "missing latitude",
        good.replace("0.5", '"x"'): "bad meter_increment",
        good.replace("02Z", "02"): "bad timestamp",
        "{}": "missing ride_id",
        "{nonsense": "malformed",
    }
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    judged = R.with_verdict(R.decode_json(df))
    assert {r.value: r.reject_reason for r in judged.collect()} == texts
    assert R.rejects(judged).count() == 5
    (row,) = R.good_rows(judged).collect()
    assert (row.latitude, row.longitude, row.meter_increment) == (1.5, -2.0, 0.5)


def test_completeness_counts_gaps_and_points_after_the_end(spark):
    rows = [("r", 5, 10, "pickup"), ("r", 7, 20, "enroute"), ("r", 7, 30, "enroute"), ("r", 4, 40, "dropoff"), ("r", 9, 50, "enroute"), ("r", None, 1, "enroute")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "message_id bigint, ride_id string, point_idx bigint, arrival_ms bigint, ride_status string")
    (r,) = feed.ride_completeness(df).collect()
    assert (r.origin, r.n_points, r.n_offsets, r.min_offset, r.max_offset, r.n_missing, r.done, r.n_after_done) == (5, 5, 4, -1, 4, 2, True, 1)


def test_bundle_average_over_frames(spark):
    rnd = random.Random(31)
    rows = [(us(w), float(la), float(lo), rnd.randint(1, 9)) for w in range(8) for la in range(3) for lo in range(5)]
    df = spark.createDataFrame(rows, "window_start_us bigint, latitude double, longitude double, ntaxis bigint")
    got = feed.bundle_average(df, 25).orderBy("cell_index").collect()
    values = [r[3] for r in rows]
    assert [r.avg_ntaxis for r in got] == [sum(values[max(0, i - 24) : i + 1]) / len(values[max(0, i - 24) : i + 1]) for i in range(len(values))]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    keys = spark.range(0, 50, 2).select(F.col("id").cast("bigint").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows.join(keys, ["k"], how)
    salted = salted_join(rows, keys, ["k"], "id", how).select(*plain.columns)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_data_clock_never_goes_back(spark):
    rows = [{"t": t, "arrival_ms": a} for t, a in [(10, 0), (5, 300), (20, 600), (1, 4_000_000), (30, 9_000_000)]]
    from meterline.operators.elementwise import ride_points

    df = trails.with_batch(ride_points(make_rides(spark, rows)))
    got = [r.clock_ms for r in feed.data_clock(df).orderBy("batch_id").collect()]
    assert got == [us(t) // 1000 for t in (10, 10, 20, 20, 30)]


def test_batch_constants():
    assert K.FADEOUT_MS % K.TICK_MS == 0 and K.GROUP_FADEOUT_MS % K.TICK_MS == 0
