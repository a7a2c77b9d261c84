"""One read of a stream, several sinks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from meterline import run
from meterline.sources import sinks
from meterline.sources.fanout import FanOut, message_parts
from meterline.sources import rides as R

GOOD = '{"ride_id":"abc","latitude":40.71,"longitude":-74,"timestamp":"2024-01-01T00:00:05Z","meter_increment":1,"ride_status":"pickup"}'
CELL = '{"ntaxis":3,"latitude":40.71,"longitude":-74}'
PANE = '{"dollar_turnover":3.5,"dollar_timing":"LATE","dollar_window":1}'


def even_and_odd(spark, path, **more):
    return FanOut(spark, str(path), {"even": lambda b: b.filter("id % 2 = 0"), "odd": lambda b: b.filter("id % 2 = 1")}, **more)


def ids(out, name):
    return sorted(r.id for r in out.read(name, "id bigint").collect())


def test_every_part_has_its_rows_once(spark, tmp_path):
    out = even_and_odd(spark, tmp_path / "out")
    assert ids(out, "even") == []
    for batch in (0, 1, 1, 0):  # batches that come again are left alone
        out.write(spark.range(10 * batch, 10 * batch + 10), batch)
    assert out.committed() == [0, 1]
    assert ids(out, "even") == list(range(0, 20, 2)) and ids(out, "odd") == list(range(1, 20, 2))


def test_a_batch_that_failed_half_way_is_completed(spark, tmp_path, monkeypatch):
    out = even_and_odd(spark, tmp_path / "out")
    out.write(spark.range(4), 0)
    with monkeypatch.context() as m:
        m.setitem(out.parts, "odd", lambda b: b.withColumn("id", F.raise_error(F.lit("no room"))))
        with pytest.raises(Exception, match="no room"):
            out.write(spark.range(4, 8), 1)
    assert out.committed() == [0] and ids(out, "even") == [0, 2]  # no reader sees the half of it
    out.write(spark.range(4, 8), 1)
    assert ids(out, "even") == [0, 2, 4, 6] and ids(out, "odd") == [1, 3, 5, 7]


def test_writers_take_rows_and_number(spark, tmp_path):
    seen = []
    out = even_and_odd(spark, tmp_path / "out", writers={"odd": lambda rows, n: seen.append((n, rows.count())), "all": lambda rows, n: seen.append((n, rows.count()))})
    out.write(spark.range(5), 7)
    assert sorted(seen) == [(7, 2), (7, 5)] and not os.path.exists(tmp_path / "out" / "odd")


def test_a_part_is_followed_as_a_stream(spark, tmp_path):
    out = even_and_odd(spark, tmp_path / "out")
    out.write(spark.range(10), 0)
    seen = []
    follow = lambda: (
        out.follow("even", "id bigint").writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .foreachBatch(lambda b, n: seen.extend(r.id for r in b.collect())).trigger(availableNow=True).start().awaitTermination()
    )
    follow()
    out.write(spark.range(10, 20), 1)
    follow()
    assert sorted(seen) == list(range(0, 20, 2))


def test_messages_of_every_kind(spark, tmp_path):
    texts = [GOOD, CELL, PANE, "{broken", "{}", '{"ride_id":null,"timestamp":"x"}', '{"dollar_run_rate_per_minute":1}']
    rows = spark.createDataFrame(list(enumerate(texts)), "message_id bigint, value string")
    out = FanOut(spark, str(tmp_path / "out"), message_parts(["message_id"]))
    out.write(R.with_verdict(R.decode_json(rows)), 0)
    got = {n: sorted(r.message_id for r in out.read(n, "message_id bigint").collect()) for n in out.parts}
    assert got == {"good": [0], "rejects": [1, 2, 3, 4, 5, 6], "ride": [0, 5], "cell": [1], "rate": [6], "pane": [2], "clock": [0, 5]}


@pytest.mark.parametrize("name", ["filter_box", "count_cells", "latest_points"])
def test_a_job_with_rejects_reads_its_source_once_and_goes_on_after_a_restart(spark, tmp_path, name):
    source = tmp_path / "in"
    os.makedirs(source)
    config = sinks.JobConfig(
        source=str(source), sink=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), trigger={"availableNow": True}, rejects=str(tmp_path / "bad")
    )
    for k in range(3):
        later = GOOD.replace("00:00:05", f"0{k}:30:05").replace('"abc"', f'"abc{k}"')
        (source / f"{k}.txt").write_text("\n".join([later, f"{{broken {k}"]))
        queries = run.start(spark, name, config)
        run.wait(spark, queries)
        readers = [q for q in queries if any(str(source) in s.description for p in q.recentProgress for s in p.sources)]
        assert len(readers) == 1
    assert sorted(r.value for r in spark.read.json(config.rejects).collect()) == [f"{{broken {k}" for k in range(3)]
    results = spark.read.text(config.sink).count()
    # a windowed job has closed all but the last window; each session has an early pane, the first a final one
    assert results == {"filter_box": 3, "count_cells": 2, "latest_points": 4}[name]
