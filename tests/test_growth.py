"""What grows with the rows of a stream: files of a replay, calls to the state store, rows of a ring, instants of a batch."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from conftest import make_rides, us
from meterline import constants as K
from meterline.operators import trails
from meterline.streaming import buckets, resent, views
from meterline.streaming import jobs as stream_jobs


def test_a_replay_has_files_for_its_rows_and_keeps_its_micro_batches(spark, monkeypatch):
    monkeypatch.setattr(stream_jobs, "FILE_ROWS", 20)
    # 200 rows in the first of four spans of arrival time, none in the second, one in each of the others
    times = [i / 100 for i in range(200)] + [25.0, 39.999]
    rides = make_rides(spark, [{"t": t} for t in times]).coalesce(1)
    stream = stream_jobs.arrival_ordered(rides, "skewed growth", 4)
    base, files = stream_jobs._REPLAYS[(spark.sparkContext.applicationId, "skewed growth")]
    assert files == 10
    names = [[n for n in stream_jobs.Store(spark, base).names(f"{base}/{k:04d}") if n.startswith("part-")] for k in range(5)]
    assert [len(n) for n in names] == [10, 10, 10, 10, 1]
    log = stream_jobs.replay(stream.select("message_id", "event_us"), "skewed growth")
    sizes = {r.emit_batch: r["count"] for r in log.groupBy("emit_batch").count().collect()}
    assert sizes == {0: 200, 2: 1, 3: 1}


class _Store:
    """A handle of one value and timers that counts its calls."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, *_):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class _Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_a_bucket_of_many_keys_takes_a_few_calls_to_the_store():
    store, bucket = _Store(), buckets._Bucket(resent._Memory(30_000), "id")
    bucket.init(store)
    arrive = lambda ids, at, mark: list(bucket.handleInputRows((0,), iter([{"id": i, "arrival_ms": at} for i in ids]), _Clock(mark)))
    assert sorted(r.id for r in arrive(range(500), 1000, 0)) == list(range(500))
    assert store.calls <= 4 and store.timers == {31_000}
    store.calls = 0
    assert sorted(r.id for r in arrive([*range(400, 600), None], 20_000, 1000) if r.id is not None) == list(range(500, 600))
    assert store.calls <= 4 and store.timers == {31_000}
    expire = lambda at, mark: list(bucket.handleExpiredTimer((0,), _Clock(mark), buckets._Expired(at)))
    store.timers.discard(31_000)  # as the engine does with a timer that fires
    assert expire(31_000, 40_000) == [] and store.timers == {50_000}
    assert len(arrive(range(500), 45_000, 40_000)) == 500
    assert len(arrive(range(500, 600), 45_000, 40_000)) == 0
    store.timers.discard(50_000)
    expire(50_000, 60_000)
    store.timers.discard(75_000)
    expire(75_000, 80_000)
    assert store.value is None and not store.timers


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
@pytest.mark.parametrize("chunk", [4, 1000])
def test_a_ring_gives_the_figures_of_the_queue(size, chunk, monkeypatch):
    monkeypatch.setattr(views, "CHUNK", chunk)
    rng, store = random.Random(size), _Store()
    ring = views._Ring(size, "key", ["a", "b"], "x", "at")
    ring.init(store)
    queue, given, got = views._Queue(size, lambda c: None, 0, 0, 0, views._EMPTY), [], []
    for k in range(8):
        rows = pd.DataFrame([(k, rng.random(), rng.randrange(-9, 9)) for _ in range(rng.randrange(1, 30))], columns=["a", "b", "x"])
        given += rows.sort_values(["a", "b"])["x"].tolist()
        parts = np.array_split(np.arange(len(rows)), 3)
        out = pd.concat(list(ring.handleInputRows(("q",), iter([rows.iloc[p] for p in parts if len(p)]), None)))
        assert set(out["key"]) == {"q"}
        got += list(out[["x", "at", "ring_sum", "ring_min", "ring_max", "rows_in_frame"]].itertuples(index=False, name=None))
        assert len(store.value[1]) <= 8 * max(0, size - 1)
    want = [(x, i, *queue.push(x)) for i, x in enumerate(given)]
    assert [tuple(map(int, r)) for r in got] == want


def test_a_ring_counts_what_is_not_there():
    store, ring = _Store(), views._Ring(2, "key", ["a"], "x", "at")
    ring.init(store)
    rows = pd.DataFrame({"a": [1, 2, 3, 4], "x": [None, None, 5, None]})
    (out,) = ring.handleInputRows(("q",), iter([rows]), None)
    assert out["ring_sum"].tolist() == [0, 0, 5, 5] and out["rows_in_frame"].tolist() == [1, 2, 2, 2]
    assert out["ring_min"].isna().tolist() == [True, True, False, False] and out["ring_max"].tolist()[2:] == [5, 5]


def test_instants_of_a_batch_are_made_after_its_shuffle(spark, monkeypatch):
    rng = random.Random(4)
    times = sorted(rng.randrange(0, 200_000) for _ in range(300))
    rows = [{"t": t / 1000, "arrival_ms": us(0) // 1000 + t, "message_id": i, "ride_id": rng.choice([*"abc", None])} for i, t in enumerate(times)]
    points = trails.with_batch(make_rides(spark, rows))
    heat = trails.ride_heat(points, K.TICK_MS)
    plan = heat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(CASE") < plan.index("Window [")  # a plan begins with what is done last
    held: dict = {}
    for r in points.select("ride_id", "batch_id").distinct().collect():
        held.setdefault(r.ride_id, []).append(r.batch_id * K.TICK_MS)
    want = set()
    for ride, born in held.items():
        for b in born:
            for at in range(b, b + K.FADEOUT_MS + K.HEAD_WEIGHT * K.TICK_MS, K.TICK_MS):
                later = sorted(x for x in born if b < x <= at)
                since = min([b + K.FADEOUT_MS, *later[:1]])
                weight = K.HEAD_WEIGHT - len(later) - max(0, (at - since) // K.TICK_MS)
                if weight > 0:
                    want.add((ride, b // K.TICK_MS, at, weight))
    got = heat.select("ride_id", "batch_id", "as_of_ms", "weight").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    only = spark.createDataFrame([(at,) for at in {w[2] for w in want} if at % 1000 == 0], "as_of_ms bigint")
    some = trails.ride_heat(points, K.TICK_MS, only).select("ride_id", "batch_id", "as_of_ms", "weight").collect()
    assert set(map(tuple, some)) == {w for w in want if w[2] % 1000 == 0}
