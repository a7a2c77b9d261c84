"""Streams against their batch twins, and labelled panes against scripted replays.

A replay is a folder with one file per micro-batch, read in file-time order.
"""

from __future__ import annotations

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import RIDES, make_rides, us
from meterline import constants as K
from meterline.operators import duplicates
from meterline.operators.aggs import upsert_latest
from meterline.plans import jobs
from meterline import run
from meterline.sources import rides as R
from meterline.sources import sinks
from meterline.streaming import jobs as stream_jobs
from meterline.streaming import panes

FAR = 1_000_000


class Script:
    """Write micro-batches as files; read them as a stream."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        os.makedirs(path, exist_ok=True)

    def add(self, rows):
        out = f"{self.path}-part{self.files}"
        make_rides(self.spark, rows).coalesce(1).write.parquet(out)
        (name,) = [n for n in os.listdir(out) if n.endswith(".parquet")]
        target = f"{self.path}/{self.files:04d}.parquet"
        os.link(f"{out}/{name}", target)
        os.utime(target, (1_700_000_000 + 10 * self.files,) * 2)
        self.files += 1
        return self

    def stream(self):
        return self.spark.readStream.schema(RIDES).option("maxFilesPerTrigger", "1").parquet(self.path)


def _run(stream, out, state, mode):
    sinks.start_pane_log(stream, out, state, {"availableNow": True}, mode).awaitTermination()
    return sinks.read_log(stream.sparkSession, out, stream.schema.add("emit_batch", "long"))


def _ordered(seed, n=400, span=3000):
    rnd = random.Random(seed)
    times = sorted(rnd.randint(0, span * 4) / 4 for _ in range(n))
    return [
        {"t": t, "message_id": i, "ride_id": rnd.choice(["hot", "hot", "a", "b", "c"]), "amount": rnd.randint(1, 999) / 100,
         "status": rnd.choice(["pickup", "enroute", "enroute", "dropoff"]), "latitude": 40 + rnd.random(), "longitude": -74 + rnd.random()}
        for i, t in enumerate(times)
    ]


@pytest.fixture
def ordered_script(spark, tmp_path):
    rows = _ordered(1)
    script = Script(spark, str(tmp_path / "in"))
    for k in range(0, len(rows), 80):
        script.add(rows[k : k + 80])
    script.add([{"t": FAR, "ride_id": "end"}])
    return rows, script


BATCH_TWINS = {
    "max_timestamp": (jobs.max_timestamp, jobs.max_timestamp),
    "count_cells": (jobs.count_cells, jobs.count_cells),
    "run_rate": (jobs.run_rate, jobs.run_rate),
    "window_turnover": (jobs.window_turnover, jobs.window_turnover),
    "latest_points": (lambda df: stream_jobs.latest_points(df, K.MINUTE_US), lambda df: jobs.latest_points(df, K.MINUTE_US)),
    "pickup_points": (stream_jobs.pickup_points, jobs.pickup_points),
}


@pytest.mark.parametrize("name", sorted(BATCH_TWINS))
def test_stream_equals_batch(spark, tmp_path, ordered_script, name):
    rows, script = ordered_script
    on_stream, on_table = BATCH_TWINS[name]
    log = _run(on_stream(stream_jobs.watermarked(script.stream())), str(tmp_path / "out"), str(tmp_path / "state"), "append")
    want = on_table(make_rides(spark, rows))
    got = log.drop("emit_batch").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_row_wise_jobs_on_a_stream(spark, tmp_path, ordered_script):
    rows, script = ordered_script
    for job in (jobs.all_rides, lambda d: jobs.filter_box(d, south=40.2, north=40.9), lambda d: jobs.filter_prefix(d, "h")):
        base = tmp_path / f"r{random.random()}"
        log = _run(job(script.stream()), str(base / "out"), str(base / "state"), "append")
        want = job(make_rides(spark, [*rows, {"t": FAR, "ride_id": "end"}]))
        assert log.count() == want.count()


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    rows = _ordered(2)
    script = Script(spark, str(tmp_path / "in")).add(rows[:150])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = lambda: jobs.run_rate(stream_jobs.watermarked(script.stream()))
    _run(job(), out, state, "append")
    script.add(rows[150:]).add([{"t": FAR}])
    log = _run(job(), out, state, "append")
    want = jobs.run_rate(make_rides(spark, rows))
    assert sorted(map(str, log.drop("emit_batch").select(*want.columns).collect())) == sorted(map(str, want.collect()))


def _write_messages(spark, path, rows, extra=()):
    from meterline.sources.sinks import as_json, ride_message

    lines = [r.value for r in as_json(ride_message(make_rides(spark, rows))).collect()]
    os.makedirs(path)
    with open(f"{path}/0.txt", "w") as f:
        f.write("\n".join([*lines, *extra]))


@pytest.mark.parametrize("name", sorted(run.JOBS))
def test_jobs_from_messages_to_messages(spark, tmp_path, name):
    rows = _ordered(4, n=120, span=300)
    rows[0]["latitude"], rows[0]["longitude"], rows[1]["ride_id"] = 40.71, -74.0, "abc"
    source = str(tmp_path / "in")
    _write_messages(spark, source, rows, ['{"ride_id":"x"}', "{}", "{nonsense"])
    config = sinks.JobConfig(
        source=source, sink=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), trigger={"availableNow": True},
        rejects=str(tmp_path / "bad"),
    )
    for query in run.start(spark, name, config):
        query.awaitTermination()
    back = spark.read.json(config.sink)
    bad = sorted(r.value for r in spark.read.json(config.rejects).collect())
    unneeded = {"all_rides": 2, "filter_prefix": 1}.get(name, 0)  # messages without the field others need
    assert "{nonsense" in bad
    assert len(bad) == 3 - unneeded
    table = make_rides(spark, rows)
    if name == "all_rides":
        assert spark.read.text(config.sink).count() == len(rows) + 2 and "passenger_count" in back.columns
    elif name == "filter_box":
        assert back.count() == jobs.filter_box(table).count() > 0
    elif name == "filter_prefix":
        assert [r.ride_id for r in back.collect()] == ["abc"]
    else:
        kind = run.JOBS[name].kind
        assert set(back.columns) - {"emit_batch"} == set(sinks.MESSAGE_COLUMNS[kind])
        assert back.count() > 0


def test_event_time_is_the_attribute_where_there_is_one(spark, tmp_path):
    text = '{"ride_id":"a","latitude":1,"longitude":2,"timestamp":"2024-01-01T00:00:05Z","meter_increment":1,"ride_status":"pickup"}'
    path = str(tmp_path / "in")
    spark.sql(f"select '{text}' value, timestamp'2024-01-01 00:10:00' ts").write.parquet(path)
    config = sinks.JobConfig(source=path, sink="", checkpoint="", source_format="parquet")
    judged = run.judge(sinks.read_messages(spark, config, stream=False), run.JOBS["latest_points"])
    (row,) = run.typed_rides(judged).collect()
    assert (row.event_us, row.timestamp.second) == (us(600), 5)


def test_resent_messages_pass_once(spark, tmp_path):
    script = Script(spark, str(tmp_path / "in"))
    script.add([{"t": 0, "message_id": 1}, {"t": 1, "message_id": 2}, {"t": 2, "message_id": 1}])
    script.add([{"t": 20, "message_id": 2}, {"t": 21, "message_id": 3}])
    log = _run(stream_jobs.drop_resent(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    assert sorted(r.message_id for r in log.collect()) == [1, 2, 3]


@pytest.mark.parametrize("cut", [1, 7])
def test_resent_messages_follow_the_batch_rule_whatever_the_cut(spark, tmp_path, cut):
    rnd = random.Random(9)
    rows = [{"t": t, "message_id": i} for i, t in [(1, 0), (2, 20), (1, 40), (1, 55), (1, 75), (3, 80), (3, 110), (3, 110.001)]]
    rows += [{"t": 200 + rnd.randrange(300_000) / 1000, "message_id": rnd.randrange(4, 9)} for _ in range(60)]
    rows.sort(key=lambda r: r["t"])
    script = Script(spark, str(tmp_path / "in"))
    size = -(-len(rows) // cut)
    for k in range(0, len(rows), size):
        script.add(rows[k : k + size])
    script.add([{"t": FAR, "message_id": -1}])
    log = _run(stream_jobs.drop_resent(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    want = duplicates.start_arrivals(make_rides(spark, rows)).select("message_id", "arrival_ms")
    got = log.where("message_id >= 0").select("message_id", "arrival_ms")
    assert sorted(got.collect()) == sorted(want.collect())
    assert [r.arrival_ms - us(0) // 1000 for r in sorted(got.where("message_id = 1").collect())] == [0, 40_000, 75_000]


def test_a_long_session_keeps_one_timer(spark, tmp_path, monkeypatch):
    """Every micro-batch moves the timer of the session; what it leaves fires once."""
    batches = [[{"t": t, "ride_id": "a", "message_id": t}] for t in range(0, 200, 10)] + [[{"t": FAR, "ride_id": "end"}]]
    rows = _session_log(spark, tmp_path, batches, lambda s: panes.latest_panes(s, gap_us=60 * K.SECOND_US))
    assert [r[1] for r in rows if r[0] == "a"].count("ON_TIME") == 1

    class Handle:
        def __init__(self):
            self.timers, self.kept = set(), []

        def getListState(self, *_):
            return self

        registerTimer = lambda self, at: self.timers.add(at)
        deleteTimer = lambda self, at: self.timers.remove(at)
        exists = lambda self: bool(self.kept)
        get = lambda self: iter(self.kept)
        clear = lambda self: self.kept.clear()

        def put(self, rows):
            self.kept = list(rows)

    class Clock:
        getCurrentWatermarkInMs = lambda self: 0

    state, handle = panes._SessionPanes(60 * K.SECOND_US, True), Handle()
    state.init(handle)
    for t in range(0, 200, 10):
        row = {"slot_us": us(t), "first_us": us(t), "last_us": us(t), "ts_ms": t, "message_id": t, "latitude": 0.0, "longitude": 0.0, "ride_status": "enroute"}
        list(state.handleInputRows(("a",), iter([row]), Clock()))
        assert len(handle.timers) == 1


# --- turnover panes -----------------------------------------------------------------

PANE_SCRIPT = [
    [(10, 1), (20, 2)], [(50, 4)], [(70, 8)], [(30, 16), (75, 32)], [(340, 64)],
    [(40, 128)], [(380, 256)], [(45, 512)], [(381, 1)], [(1000, 1)],
]
PANES = {
    0: ["EARLY 3", "EARLY 7", "ON_TIME 7", "LATE 23", "LATE 151"],
    60: ["EARLY 8", "EARLY 40", "ON_TIME 40"],
    300: ["EARLY 64", "ON_TIME 64"],
    360: ["EARLY 256", "EARLY 257", "ON_TIME 257"],
    960: ["EARLY 1"],
}
RANK = {"EARLY": 0, "ON_TIME": 1, "LATE": 2}


def _by_window(log):
    got = {}
    for r in sorted(log.collect(), key=lambda r: (RANK[r.dollar_timing], r.emit_batch)):
        got.setdefault((r.window_start_us - us(0)) // 1_000_000, []).append(f"{r.dollar_timing} {int(r.dollar_turnover)}")
    return got


def test_scripted_turnover_panes(spark, tmp_path):
    script = Script(spark, str(tmp_path / "in"))
    for batch in PANE_SCRIPT:
        script.add([{"t": t, "amount": float(a)} for t, a in batch])
    log = _run(panes.turnover_panes(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    assert _by_window(log) == PANES


def test_turnover_panes_survive_a_restart(spark, tmp_path):
    script = Script(spark, str(tmp_path / "in"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for half in (PANE_SCRIPT[:4], PANE_SCRIPT[4:]):
        for batch in half:
            script.add([{"t": t, "amount": float(a)} for t, a in batch])
        log = _run(panes.turnover_panes(script.stream()), out, state, "update")
    assert _by_window(log) == PANES
    board = upsert_latest(log, ["dollar_window"], F.struct("emit_batch", F.col("dollar_timing") == "LATE"))
    assert board.count() == len(PANES)


def test_panes_after_an_in_order_replay_end_in_the_batch_turnover(spark, tmp_path, ordered_script):
    rows, script = ordered_script
    log = _run(panes.turnover_panes(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    final = {r.window_start_us: r.dollar_turnover for r in log.collect() if r.dollar_timing == "ON_TIME"}
    assert final == {r.window_start_us: r.dollar_turnover for r in jobs.window_turnover(make_rides(spark, rows)).collect()}


# --- session panes --------------------------------------------------------------------

def _session_log(spark, tmp_path, batches, build):
    script = Script(spark, str(tmp_path / "in"))
    for batch in batches:
        script.add(batch)
    log = _run(build(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    rows = sorted(log.collect(), key=lambda r: (r.emit_batch, RANK[r.pane_timing] != 1, r.ride_id, r.session_start_us))
    return [
        (r.ride_id, r.pane_timing, (r.session_start_us - us(0)) // 1_000_000, (r.session_end_us - us(0)) // 1_000_000, r.message_id)
        for r in rows
    ]


def test_scripted_latest_panes(spark, tmp_path):
    batches = [
        [{"t": 0, "message_id": 1}, {"t": 10, "message_id": 2}],
        [{"t": 65, "message_id": 3}],  # within a minute of the last point: the session grows
        [{"t": 125, "message_id": 4}],  # exactly one gap later: a new session
        [{"t": 60, "message_id": 5}],  # late by its own minute: dropped
        [{"t": 126, "message_id": 6}, {"t": 300, "message_id": 7, "ride_id": "b"}],
        [{"t": 127, "message_id": 8}],  # long past: dropped
    ]
    got = _session_log(spark, tmp_path, batches, lambda s: panes.latest_panes(s, K.MINUTE_US))
    assert got[:3] == [("a", "EARLY", 0, 70, 2), ("a", "EARLY", 0, 125, 3), ("a", "EARLY", 125, 185, 4)]
    rest = got[3:]
    assert ("a", "ON_TIME", 0, 125, 3) in rest and ("a", "EARLY", 125, 186, 6) in rest
    assert ("a", "ON_TIME", 125, 186, 6) in rest and ("b", "EARLY", 300, 360, 7) in rest
    assert len(rest) == 4 and not any(r[4] in (5, 8) for r in got)


def test_scripted_sessions_merge(spark, tmp_path):
    batches = [
        [{"t": 0, "message_id": 1}, {"t": 100, "message_id": 2}],
        [{"t": 50, "message_id": 3}],  # joins the two
    ]
    got = _session_log(spark, tmp_path, batches, lambda s: panes.latest_panes(s, K.MINUTE_US, delay_us=K.MINUTE_US))
    assert ("a", "EARLY", 0, 60, 1) in got and ("a", "EARLY", 100, 160, 2) in got
    assert got[-1] == ("a", "EARLY", 0, 160, 2)


def test_scripted_pickup_panes(spark, tmp_path):
    batches = [
        [{"t": 0, "message_id": 1}],  # no pickup yet: nothing to show
        [{"t": 30, "message_id": 2, "status": "pickup"}],
        [{"t": 60, "message_id": 3, "status": "pickup"}],
        [{"t": 20, "message_id": 4, "status": "pickup"}],  # an earlier one
        [{"t": 500, "message_id": 5}],
        [{"t": 1000, "message_id": 6}],
    ]
    got = _session_log(spark, tmp_path, batches, panes.pickup_panes)
    assert got == [
        ("a", "EARLY", 0, 90, 2), ("a", "EARLY", 0, 120, 2), ("a", "EARLY", 0, 120, 4), ("a", "ON_TIME", 0, 120, 4),
    ]


@pytest.mark.parametrize("latest", [True, False])
def test_on_time_session_panes_equal_batch(spark, tmp_path, ordered_script, latest):
    rows, script = ordered_script
    build = (lambda s: panes.latest_panes(s, K.MINUTE_US)) if latest else panes.pickup_panes
    log = _run(build(script.stream()), str(tmp_path / "out"), str(tmp_path / "state"), "update")
    table = make_rides(spark, rows)
    want = jobs.latest_points(table, K.MINUTE_US) if latest else jobs.pickup_points(table)
    got = log.filter((F.col("pane_timing") == "ON_TIME") & (F.col("ride_id") != "end")).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# --- settings of a run -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(run.JOBS))
def test_odd_numbers_stop_no_job(spark, tmp_path, name):
    good = '{"ride_id":"abc","latitude":40.71,"longitude":-74,"timestamp":"2024-01-01T00:00:05Z","meter_increment":1,"ride_status":"pickup"}'
    odd = [good.replace('"meter_increment":1', f'"meter_increment":"{x}"') for x in ("NaN", "Infinity", "1e10", "-1e300")]
    odd += [good.replace('"latitude":40.71', f'"latitude":"{x}"') for x in ("NaN", "-Infinity", "91")]
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "0.txt").write_text("\n".join([good, *odd]))
    args = ["--job", name, "--source", str(tmp_path / "in"), "--sink", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "state")]
    config = run.configured(run.arguments().parse_args([*args, "--rejects", str(tmp_path / "bad"), "--once"]))
    run.wait(spark, run.start(spark, name, config))
    needed = run.JOBS[name].needs
    bad = 4 * ("meter_increment" in needed) + 3 * ("latitude" in needed)
    assert spark.read.text(config.rejects).count() == bad


def test_flags_reach_the_source_and_the_sink():
    args = ["--job", "all_rides", "--source", "rides", "--sink", "out", "--checkpoint", "c", "--source-format", "kafka", "--event-time", "when"]
    args += ["--source-option", "kafka.bootstrap.servers=h:9092", "--per-trigger", "500", "--sink-option", "a=b=c", "--trigger-seconds", "3"]
    config = run.configured(run.arguments().parse_args(args))
    assert config.trigger == {"processingTime": "3.0 seconds"} and config.sink_options == {"a": "b=c"}
    assert sinks.source_options(config) == {
        "subscribe": "rides", "includeHeaders": "true", "maxOffsetsPerTrigger": "500", "kafka.bootstrap.servers": "h:9092"
    }


def test_kafka_event_time_is_the_header(spark):
    when = datetime(2024, 1, 1)
    records = [("a", [("when", b"2024-01-01T00:10:00Z")]), ("b", [("other", b"x")]), ("c", None)]
    schema = "value binary, timestamp timestamp, headers array<struct<key:string,value:binary>>"
    rows = spark.createDataFrame([(v.encode(), when, h) for v, h in records], schema)
    got = {r.value: r.ts.minute for r in sinks.kafka_values(rows, "when").collect()}
    assert got == {"a": 10, "b": 0, "c": 0}


def test_event_time_column_by_name(spark, tmp_path):
    spark.sql("select '{}' value, timestamp'2024-01-01 00:10:00' at").write.parquet(str(tmp_path / "in"))
    config = sinks.JobConfig(source=str(tmp_path / "in"), sink="", checkpoint="", source_format="parquet", event_time="at")
    assert sinks.read_messages(spark, config, stream=False).first().ts.minute == 10


def test_failure_of_any_query_ends_the_run(spark, tmp_path):
    script = Script(spark, str(tmp_path / "in")).add([{"t": 0}])

    def fail(batch, batch_id):
        raise ValueError("no sink")

    lasting = script.stream().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    failing = script.stream().writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "b")).start()
    with pytest.raises(Exception, match="no sink"):
        run.wait(spark, [lasting, failing])
    assert not lasting.isActive
    spark.streams.resetTerminated()
