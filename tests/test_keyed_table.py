"""The keyed table: upserts by bucket, exactly once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from meterline.sources.keyed_table import KeyedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("amount", T.DoubleType())])


def table(spark, path, **more):
    return KeyedTable(spark, str(path), SCHEMA, ("k", "name"), ("seq",), **{"buckets": 4, **more})


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(t, version=None):
    return sorted(map(tuple, t.read(version).collect()), key=str)


def test_upserts_leave_the_newest_row_of_every_key(spark, tmp_path):
    rng, t, want = random.Random(1), table(spark, tmp_path / "t", slices=2), {}
    assert rows_of(t) == [] and t.versions() == []
    for batch in range(4):
        rows = [(rng.randrange(30), rng.choice(["a", None, ""]), s, rng.random()) for s in rng.sample(range(1000), 40)]
        assert t.upsert(frame(spark, rows), batch)
        fresh = {}
        for row in sorted(rows, key=lambda r: r[2]):
            fresh[row[:2]] = row
        want |= fresh
        assert rows_of(t) == sorted(want.values(), key=str)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.upsert(frame(spark, [(1, "a", 1, 1.0)]), 0)
    assert t.upsert(frame(spark, [(1, "a", 0, 2.0)]), 1)  # later batches win whatever their order column says
    before = t.manifest()
    assert not t.upsert(frame(spark, [(1, "a", 9, 9.0)]), 1) and not t.upsert(frame(spark, [(2, "b", 9, 9.0)]), 0)
    assert t.manifest() == before and rows_of(t) == [(1, "a", 0, 2.0)]
    assert t.upsert(frame(spark, [(2, "b", 1, 3.0)]), 0, stream="other")  # a stream of its own counts its own batches
    assert rows_of(t) == [(1, "a", 0, 2.0), (2, "b", 1, 3.0)]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=16)
    t.upsert(frame(spark, [(k, "x", 0, 0.0) for k in range(200)]), 0)
    before = t.manifest()["folders"]
    t.upsert(frame(spark, [(7, "x", 0, 7.0)]), 1)
    after = t.manifest()["folders"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert [tuple(r) for r in t.changes(1).collect()] == [(7, "x", 0, 7.0)]
    assert t.changes(0).count() == 200 and t.changes(2).count() == 0


def test_versions_are_read_back_and_dropped(spark, tmp_path):
    t = table(spark, tmp_path / "t", keep=2)
    for batch in range(4):
        t.upsert(frame(spark, [(1, "a", 0, float(batch)), (batch + 10, "b", 0, 0.0)]), batch)
    assert t.versions() == [3, 4]
    assert (1, "a", 0, 2.0) in rows_of(t, 3) and (1, "a", 0, 3.0) in rows_of(t)
    assert len(rows_of(t)) == 5 and len(rows_of(t, 3)) == 4


def test_what_a_failed_attempt_leaves_is_not_read(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, [(1, "a", 0, 1.0)]), 0)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr("meterline.sources.files.Store.publish", fail)
        with pytest.raises(OSError, match="lost"):
            t.upsert(frame(spark, [(1, "a", 0, 2.0)]), 1)
    assert rows_of(t) == [(1, "a", 0, 1.0)]
    assert t.upsert(frame(spark, [(1, "a", 0, 2.0)]), 1) and rows_of(t) == [(1, "a", 0, 2.0)]
    # a second writer that has read the same version cannot publish over it
    with pytest.raises(FileExistsError):
        t._store().publish(t._named(t.versions()[-1]), "{}")


def test_an_empty_batch_is_a_version(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.upsert(frame(spark, []), 0) and t.versions() == [1] and rows_of(t) == []
    assert not t.upsert(frame(spark, [(1, "a", 0, 1.0)]), 0)
