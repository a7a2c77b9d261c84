"""Live views: restarts, cuts into micro-batches, and scripted clocks."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import make_rides, us
from meterline import constants as K
from meterline.operators import combine, elementwise, trails
from meterline.plans import jobs
from meterline.sources import sinks
from meterline.sources.keyed_table import KeyedTable
from meterline.streaming import combined, late, panes, union, views
from meterline.streaming import jobs as stream_jobs
from test_streaming import FAR, Script, _run


def arriving(seed, n=160):
    """Rows in order of arrival, some of them late."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        t = i * 3
        late_by = rng.choice([0, 0, 0, 0, 30, 200, 700])
        rows.append({
            "t": max(0, t - late_by), "arrival_ms": us(t) // 1000, "message_id": i, "ride_id": rng.choice(["a", "a", "b", "c"]),
            "amount": rng.randrange(1, 500) / 100, "status": rng.choice(["pickup", "enroute", "dropoff"]),
        })
    return rows


def points(stream):
    return stream.withColumn("point_idx", F.col("message_id"))


VIEWS = {
    "gaps": (lambda s: views.ride_gaps(points(s)), lambda log: views.open_gaps(log)),
    "trails": (lambda s: views.ride_trails(trails.with_batch(s)), lambda log: sinks.log_state(log, ["message_id"]).filter("weight > 0").drop("emit_batch")),
    "fading": (lambda s: views.ride_fading(trails.with_batch(s)), lambda log: log.drop("emit_batch")),
    "limits": (
        lambda s: views.cull_limits(s.select((F.col("message_id") % 90 + 1).alias("ntaxis"), F.expr("arrival_ms div 250 * 250").alias("arrival_ms"))),
        lambda log: log.filter(F.col("as_of_ms") < us(FAR) // 1000).drop("emit_batch"),
    ),
    "late": (late.label_rows, lambda log: log.drop("emit_batch")),
    "late_sums": (late.label_windows, late.class_totals),
    "combined": (
        lambda s: combined.combine_sessions(elementwise.ride_points(s), 60 * K.SECOND_US, combine.latest_point(), delay_us=800 * K.SECOND_US, early=True),
        lambda log: log.drop("emit_batch"),
    ),
    "ring": (lambda s: views.ring(s.filter("ride_id <> 'end'"), "ride_id", ["message_id"], "arrival_ms", 7, "at"), lambda log: log.drop("emit_batch")),
    "health": (
        lambda s: views.feed_health(s.select(F.col("ride_id").alias("feed_id"), F.col("arrival_ms").alias("at_ms"), F.lit(3).cast("bigint").alias("n_messages"), F.lit(0).cast("bigint").alias("n_duplicates"))),
        lambda log: log.drop("emit_batch"),
    ),
}


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_a_view_goes_on_after_a_restart(spark, tmp_path, name):
    build, finish = VIEWS[name]
    rows = arriving(5, 120)
    batches = [rows[k : k + 40] for k in range(0, len(rows), 40)] + [[{"t": FAR, "ride_id": "end", "message_id": 10_000}]]

    def logged(at, cuts):
        script = Script(spark, str(tmp_path / at / "in"))
        for part in cuts:
            for batch in part:
                script.add(batch)
            log = _run(build(script.stream()), str(tmp_path / at / "out"), str(tmp_path / at / "state"), "update")
        return sorted(map(str, finish(log).collect()))

    once = logged("once", [batches])
    assert once and logged("twice", [batches[:1], batches[1:]]) == once


@pytest.mark.parametrize("name", ["gaps", "trails", "fading", "limits", "ring", "health"])
def test_a_view_does_not_depend_on_the_cut(spark, tmp_path, name):
    build, finish = VIEWS[name]
    rows, got = arriving(6, 120), []
    for size in (40, 120):
        script = Script(spark, str(tmp_path / f"in{size}"))
        for k in range(0, len(rows), size):
            script.add(rows[k : k + size])
        script.add([{"t": FAR, "ride_id": "end", "message_id": 10_000}])
        log = _run(build(script.stream()), str(tmp_path / f"out{size}"), str(tmp_path / f"state{size}"), "update")
        got.append(sorted(map(str, finish(log).collect())))
    assert got[0] == got[1]


def test_nothing_is_lost_between_the_classes(spark, tmp_path):
    script = Script(spark, str(tmp_path / "in"))
    for batch in [[(10, 1), (20, 2)], [(130, 4)], [(30, 8)], [(500, 16)], [(45, 32), (140, 64), (499, 128)], [(46, 256)]]:
        script.add([{"t": t, "message_id": a, "amount": float(a)} for t, a in batch])
    rows = _run(late.label_rows(script.stream()), str(tmp_path / "a"), str(tmp_path / "b"), "update")
    got = {r.message_id: r.lateness for r in rows.collect()}
    assert got == {1: "ON_TIME", 2: "ON_TIME", 4: "ON_TIME", 8: "LATE", 16: "ON_TIME", 32: "DROPPED", 64: "DROPPED", 128: "ON_TIME", 256: "DROPPED"}
    sums = late.class_totals(_run(late.label_windows(script.stream()), str(tmp_path / "c"), str(tmp_path / "d"), "update"))
    assert {((r.window_start_us - us(0)) // 1_000_000, r.lateness): (r.n_points, r.dollars) for r in sums.collect()} == {
        (0, "ON_TIME"): (2, 3.0), (0, "LATE"): (1, 8.0), (0, "DROPPED"): (2, 288.0), (120, "ON_TIME"): (1, 4.0),
        (120, "DROPPED"): (1, 64.0), (480, "ON_TIME"): (2, 144.0),
    }


def test_the_board_is_upserted_across_a_restart(spark, tmp_path):
    rows = arriving(8)
    script, table = Script(spark, str(tmp_path / "in")), None
    for part in (rows[:80], rows[80:] + [{"t": FAR}]):
        for k in range(0, len(part), 40):
            script.add(part[k : k + 40])
        out = panes.turnover_panes(script.stream()).withColumn("rank", F.col("dollar_timing") == "LATE")
        table = KeyedTable(spark, str(tmp_path / "t"), out.schema, ("window_start_us",), ("rank",), buckets=4)
        writer = out.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "s")).foreachBatch(table.writer())
        writer.trigger(availableNow=True).start().awaitTermination()
    log = _run(panes.turnover_panes(script.stream()), str(tmp_path / "a"), str(tmp_path / "b"), "update")
    order = F.struct("emit_batch", F.col("dollar_timing") == "LATE")
    want = log.groupBy("window_start_us").agg(F.max_by("dollar_turnover", order).alias("d"))
    assert sorted(map(tuple, table.read().select("window_start_us", "dollar_turnover").collect())) == sorted(map(tuple, want.collect()))


def test_a_live_feed_falls_silent_while_nothing_arrives(spark, tmp_path):
    pulls = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter("value < 2")
    feed = pulls.select(F.lit("f").alias("feed_id"), F.lit(0).cast("bigint").alias("at_ms"), F.lit(5).cast("bigint").alias("n_messages"), F.lit(0).cast("bigint").alias("n_duplicates"))
    health, seen = views.feed_health(feed, silent_ms=2500, live=True), []
    query = (
        health.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "s"))
        .foreachBatch(lambda b, n: seen.extend(b.collect())).trigger(processingTime="500 milliseconds").start()
    )
    end = time.time() + 90
    while time.time() < end and not any(r.status == "none" for r in seen):
        time.sleep(0.5)
    query.stop()
    assert [r.status for r in sorted(seen, key=lambda r: r.at_ms)][-1] == "none" and seen[0].status == "ok"


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 15, 16, 100])
def test_the_queue_of_two_stacks(size):
    rng, values, kept, state, loads = random.Random(size), [], {}, (0, 0, 0, views._EMPTY), 0
    for _ in range(60):  # micro-batches of their own, with nothing but the stored chunks between them
        def load(c):
            nonlocal loads
            loads += 1
            found = kept.get(c)
            return found and {"values": list(found["values"]), "whole": found["whole"], "after": found["after"]}

        queue = views._Queue(size, load, *state)
        for _ in range(rng.randrange(1, 12)):
            values.append(rng.randrange(-9, 9))
            last = values[-size:]
            assert queue.push(values[-1]) == (sum(last), min(last), max(last), len(last))
        kept |= {c: dict(queue.chunk(c)) for c in queue.changed}
        for c in queue.dropped:
            kept.pop(c, None)
        state = (queue.head, queue.tail, queue.middle, queue.back)
        assert sum(len(c["values"]) for c in kept.values()) <= size + 2 * queue.width
    assert loads < 60 * 6 + 3 * len(values)


def test_fading_like_the_table_form(spark, tmp_path):
    rng = random.Random(2)
    at = sorted(rng.randrange(0, 40_000) for _ in range(60))
    rows = [{"t": a / 1000, "arrival_ms": us(0) // 1000 + a, "message_id": i, "ride_id": rng.choice("ab")} for i, a in enumerate(at)]
    script = Script(spark, str(tmp_path / "in"))
    for k in range(0, 60, 13):
        script.add(rows[k : k + 13])
    script.add([{"t": FAR, "ride_id": "end"}])
    log = _run(views.ride_fading(trails.with_batch(script.stream())), str(tmp_path / "a"), str(tmp_path / "b"), "update").collect()
    table = trails.ride_heat(trails.with_batch(make_rides(spark, rows)), K.TICK_MS).collect()
    want = {(r.ride_id, r.batch_id * K.TICK_MS, r.as_of_ms): r.weight for r in table}
    changes = {}
    for r in log:
        if r.ride_id != "end":
            changes.setdefault((r.ride_id, r.batch_ms), []).append((r.at_ms, r.weight))
    got = {}
    for (ride, batch), steps in changes.items():
        steps.sort()
        assert steps[-1][1] == 0 and all(a[1] > b[1] for a, b in zip(steps, steps[1:], strict=False))
        for (begin, weight), (end, _) in zip(steps, steps[1:], strict=False):
            got |= {(ride, batch, t): weight for t in range(begin, end, K.TICK_MS)}
    assert got == want


def test_limits_like_the_table_form(spark, tmp_path):
    rng = random.Random(3)
    rows = [(us(0) // 1000 + 250 * rng.randrange(200), rng.choice([1, 3, 4, 9, 40, 300])) for _ in range(50)]
    cells = spark.createDataFrame(sorted(rows), "arrival_ms bigint, ntaxis bigint").withColumns({"latitude": F.rand(1), "longitude": F.rand(2)})
    want = {r.as_of_ms: r.limit for r in trails.heat_limits(cells).collect() if r.limit}
    path, far = str(tmp_path / "in"), us(FAR) // 1000
    log = None
    for part in (sorted(rows)[:20], sorted(rows)[20:], [(far, 1000)]):
        spark.createDataFrame(part, "arrival_ms bigint, ntaxis bigint").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("arrival_ms bigint, ntaxis bigint").parquet(path)
        log = _run(views.cull_limits(stream), str(tmp_path / "a"), str(tmp_path / "b"), "update")
    assert {r.as_of_ms: r.limit for r in log.collect() if r.as_of_ms < far} == want


@pytest.mark.parametrize(("policy", "idle", "kept"), [("slowest", None, 6), ("fastest", None, 5), ("slowest", "100 seconds", 5)])
def test_sources_with_clocks_of_their_own(spark, tmp_path, policy, idle, kept):
    """b stands still at 10 s while a goes on; a row of b for second 20 comes after a has passed 500 s."""
    fast, slow = Script(spark, str(tmp_path / "fast")), Script(spark, str(tmp_path / "slow"))
    for a, b in [([0], [10]), ([500], []), ([501], []), ([502], [20])]:
        fast.add([{"t": t, "ride_id": "a"} for t in a])
        slow.add([{"t": t, "ride_id": "b"} for t in b])
    fast.add([{"t": FAR, "ride_id": "end"}]), slow.add([{"t": FAR, "ride_id": "end"}])
    both = union.union_sources([(fast.stream(), "0 seconds"), (slow.stream(), "0 seconds")], policy, idle)
    log = _run(jobs.max_timestamp(both), str(tmp_path / "a"), str(tmp_path / "b"), "append")
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    assert log.filter(F.col("window_start_us") < us(FAR - 10)).count() == kept
