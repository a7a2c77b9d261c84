"""Views of the live feed as keyed state: health, rings, missing ranges and trails.

Each view emits what changes, in update mode. Rows of one key come in the order of their arrival from one micro-batch to the
next, and are sorted within one; results do not depend on the cut into micro-batches unless a function says so.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline import constants as K
from meterline.streaming.buckets import each_key

# the state classes travel to the workers by value, see panes
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- feed health ---------------------------------------------------------------

class _Health(StatefulProcessor):
    """State of a feed: its last pull batches (a ring of few) and one timer, when it will have been silent too long."""

    def __init__(self, size: int, pull_size: int, silent_ms: int, share: float, live: bool) -> None:
        self.size, self.pull_size, self.silent_ms, self.share, self.live = size, pull_size, silent_ms, share, live

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getListState("ring", "at_ms bigint, n_messages bigint, n_duplicates bigint")
        self.silent = handle.getValueState("silent", "since_ms bigint")

    def _status(self, ring: list[tuple]) -> tuple[float, str]:
        seconds = (ring[-1][0] - ring[0][0]) / 1000.0 or 1.0
        rate = math.floor(sum(r[1] for r in ring) / seconds * 10.0 + 0.5) / 10.0
        rate = float(math.floor(rate + 0.5)) if rate >= 1 else rate
        if rate == 0:
            return rate, "none"
        if sum(r[2] for r in ring) > 0:
            return rate, "severe"
        full = sum(r[1] == self.pull_size for r in ring)
        return rate, "overload" if full / len(ring) > self.share else "ok"

    def _none(self, key, last_ms: int) -> Row:
        return Row(feed_id=key[0], at_ms=last_ms + self.silent_ms, data_rate=0.0, status="none")

    def handleInputRows(self, key, rows, timerValues):
        ring = [tuple(r) for r in self.ring.get()] if self.ring.exists() else []
        told, before = self.silent.exists(), ring[-1][0] if ring else None
        pulls = sorted((r["at_ms"], r["n_messages"], r["n_duplicates"]) for r in rows)
        if self.live:  # what came in this micro-batch is one pull, now
            now = timerValues.getCurrentProcessingTimeInMs()
            pulls = [(now, sum(p[1] for p in pulls), sum(p[2] for p in pulls))]
        for pull in pulls:
            if ring and pull[0] - ring[-1][0] > self.silent_ms and not told:
                yield self._none(key, ring[-1][0])
            told = False
            ring = [*ring, pull][-self.size :]
            rate, status = self._status(ring)
            yield Row(feed_id=key[0], at_ms=pull[0], data_rate=rate, status=status)
        self.ring.put(ring)
        self.silent.clear()
        if before is not None:
            self.handle.deleteTimer(before + self.silent_ms + 1)
        self.handle.registerTimer(ring[-1][0] + self.silent_ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.ring.exists() and not self.silent.exists():
            last = [r[0] for r in self.ring.get()][-1]
            if expiredTimerInfo.getExpiryTimeInMs() == last + self.silent_ms + 1:
                self.silent.update((last + self.silent_ms,))
                yield self._none(key, last)

    def close(self) -> None:
        pass


def feed_health(
    pulls: DataFrame,
    size: int = K.HEALTH_BATCHES,
    pull_size: int = K.PULL_SIZE,
    silent_ms: int = K.SILENT_AFTER_MS,
    share: float = K.SATURATED_SHARE,
    live: bool = False,
) -> DataFrame:
    """Rate and status of each feed after every pull, and "none" once it has been silent for ``silent_ms``.

    ``pulls`` has feed_id, at_ms (when the pull came), n_messages and n_duplicates. The clock is the pulls' own: a feed
    is silent when other feeds have moved on. With ``live`` it is the wall clock: a feed becomes "none" although nothing
    arrives at all, and all that a micro-batch has of a feed is one pull.
    """
    rows = pulls.select("feed_id", "at_ms", "n_messages", "n_duplicates")
    if not live:
        rows = rows.withColumn("event_ts", F.timestamp_millis("at_ms")).withWatermark("event_ts", "0 seconds")
    return rows.groupBy("feed_id").transformWithState(
        statefulProcessor=_Health(size, pull_size, silent_ms, share, live),
        outputStructType="feed_id string, at_ms bigint, data_rate double, status string",
        outputMode="Update",
        timeMode="ProcessingTime" if live else "EventTime",
    )


# --- the last n rows -------------------------------------------------------------

_EMPTY = (0, None, None)


def _joined(a: tuple, b: tuple) -> tuple:
    """Sum, least and greatest of two parts."""
    if a[1] is None or b[1] is None:
        return b if a[1] is None else a
    return a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])


def _suffixes(parts: list[tuple]) -> list[tuple]:
    """For every place the sum, least and greatest from there to the end."""
    out, now = [], _EMPTY
    for part in reversed(parts):
        now = _joined(part, now)
        out.append(now)
    return out[::-1]


class _Queue:
    """The last ``size`` numbers with their sum, least and greatest, one number at a time: a queue of two stacks over chunks.

    ``_figures`` gives the same for many numbers at once.

    Numbers lie in chunks. A whole chunk has its sum, least and greatest, and, once it is in the front stack, those of
    all front chunks after it. A number costs constant work on average, and a micro-batch touches the first chunk, the
    last one and those that it fills; only when the front stack is used up, once per ``size`` rows, are all chunks' figures read.
    """

    def __init__(self, size: int, load, head: int, tail: int, middle: int, back: tuple) -> None:
        self.size, self.width = size, max(1, math.isqrt(size))
        self.load, self.kept, self.changed, self.dropped = load, {}, set(), []
        self.head, self.tail, self.middle, self.back = head, tail, middle, back
        self.first = None  # suffixes of the first chunk

    def chunk(self, c: int) -> dict:
        if c not in self.kept:
            self.kept[c] = self.load(c) or {"values": [], "whole": _EMPTY, "after": _EMPTY}
        return self.kept[c]

    def push(self, x: int) -> tuple:
        """Sum, least and greatest of what the queue holds now, and how many."""
        last = self.tail // self.width
        chunk = self.chunk(last)
        chunk["values"].append(x)
        chunk["whole"] = _joined(chunk["whole"], (x, x, x))
        self.changed.add(last)
        self.tail += 1
        if self.tail % self.width == 0 and last >= self.middle:
            self.back = _joined(self.back, chunk["whole"])
        if self.tail - self.head > self.size:
            self._pop()
        return *self._figures(), self.tail - self.head

    def _pop(self) -> None:
        was = self.head // self.width
        self.head += 1
        if self.head // self.width != was:
            self.first = None
            self.kept.pop(was, None)
            self.changed.discard(was)
            self.dropped.append(was)

    def _figures(self) -> tuple:
        start, last = self.head // self.width, self.tail // self.width
        if start >= self.middle:  # the front stack is used up: all whole chunks become the new one
            now = _EMPTY
            for c in range(last - 1, start - 1, -1):
                chunk = self.chunk(c)
                chunk["after"], now = now, _joined(chunk["whole"], now)
                self.changed.add(c)
            self.middle, self.back, self.first = max(last, start), _EMPTY, None
        if start == last:  # a single chunk, still growing
            part = _EMPTY
            for x in self.chunk(start)["values"][self.head % self.width :]:
                part = _joined(part, (x, x, x))
            return part
        if self.first is None:
            self.first = _suffixes([(x, x, x) for x in self.chunk(start)["values"]])
        front = _joined(self.first[self.head % self.width], self.chunk(start)["after"])
        growing = self.chunk(last)["whole"] if self.tail % self.width else _EMPTY
        return _joined(_joined(front, self.back), growing)


_RING_OUT = "ring_sum bigint, ring_min bigint, ring_max bigint, rows_in_frame bigint"


#: Rows of a chunk of results.
CHUNK = 50_000


def _sliding(numbers: np.ndarray, size: int, join: np.ufunc) -> np.ndarray:
    """``join`` (least or greatest) of the last ``size`` numbers up to each place.

    A window of ``size`` lies in two blocks of that size: what it has of the first one is joined from there to the
    block's end, what it has of the second from the block's beginning.
    """
    size = min(size, max(1, len(numbers)))
    filled = np.concatenate([numbers, np.repeat(numbers[-1:], -len(numbers) % size)]).reshape(-1, size)
    upto = join.accumulate(filled, axis=1).ravel()[: len(numbers)]
    since = join.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    out = upto.copy()
    out[size - 1 :] = join(since[: len(numbers) - size + 1], upto[size - 1 :])
    return out


def _figures(numbers: np.ndarray, there: np.ndarray, size: int) -> dict[str, pd.Series]:
    """Sum, least and greatest of the last ``size`` numbers up to each place, and how many; what is not there only counts."""
    ends = np.arange(1, len(numbers) + 1)
    starts = np.maximum(0, ends - size)
    sums, seen = (np.concatenate([[0], np.cumsum(x)]) for x in (np.where(there, numbers, 0), there))
    none = seen[ends] == seen[starts]
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    least = _sliding(np.where(there, numbers, high), size, np.minimum)
    most = _sliding(np.where(there, numbers, low), size, np.maximum)
    shown = {"ring_min": pd.Series(pd.arrays.IntegerArray(least, none)), "ring_max": pd.Series(pd.arrays.IntegerArray(most, none))}
    return {"ring_sum": pd.Series(sums[ends] - sums[starts]), **shown, "rows_in_frame": pd.Series(ends - starts)}


class _Ring(StatefulProcessor):
    """State of a key: how many rows it had, and the last of their numbers, one less than a frame has."""

    def __init__(self, size: int, key: str, order: list[str], value: str, index: str) -> None:
        self.size, self.key, self.order, self.value, self.index = size, key, order, value, index

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "n bigint, numbers binary, there binary")

    def handleInputRows(self, key, rows, timerValues):
        fresh = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", na_position="first", ignore_index=True)
        n, numbers, there = self.last.get() if self.last.exists() else (0, b"", b"")
        given = fresh[self.value].notna().to_numpy(bool)
        numbers = np.concatenate([np.frombuffer(bytes(numbers), np.int64), fresh[self.value].fillna(0).to_numpy(np.int64)])
        there = np.concatenate([np.frombuffer(bytes(there), bool), given])
        old = len(numbers) - len(fresh)
        for at in range(0, len(fresh), CHUNK):
            rows_here = fresh.iloc[at : at + CHUNK].reset_index(drop=True)
            # a chunk looks back on the numbers of the frame before it
            first, end = max(0, old + at - self.size + 1), old + at + len(rows_here)
            figures = {name: s.iloc[old + at - first :].reset_index(drop=True) for name, s in _figures(numbers[first:end], there[first:end], self.size).items()}
            named = {c: rows_here[c] for c in [*self.order, self.value]}
            yield pd.DataFrame({self.key: [key[0]] * len(rows_here), **named, self.index: n + at + np.arange(len(rows_here)), **figures})
        kept = min(self.size - 1, len(numbers))
        self.last.update((n + len(fresh), numbers[len(numbers) - kept :].tobytes(), there[len(there) - kept :].tobytes()))

    def close(self) -> None:
        pass


def ring(rows: DataFrame, key: str, order: list[str], value: str, size: int, index: str) -> DataFrame:
    """After each row of a key, in the given order, the figures of the last ``size`` values, and its index from 0.

    Rows of one micro-batch come before those of the next. A key is one queue, so this is for reduced rows, such as pull
    batches or counted cells: a task holds the named columns of what a micro-batch has of a key, as plain arrays.
    """
    kinds = dict(rows.dtypes)
    columns = [key, *order, value]
    fields = ", ".join(f"{c} {kinds[c]}" for c in columns)
    out = rows.select(*columns).groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Ring(size, key, order, value, index),
        outputStructType=f"{fields}, {index} bigint, {_RING_OUT}",
        outputMode="Update",
        timeMode="None",
    )
    average = F.col("ring_sum") / F.col("rows_in_frame")
    return out.withColumns({"ring_avg": average, "ring_span": F.col("ring_max") - F.col("ring_min")})


# --- missing ranges of a ride ------------------------------------------------------

def runs(numbers: list[int]) -> list[list[int]]:
    """Sorted numbers as runs [first, last] without a hole."""
    out: list[list[int]] = []
    for x in sorted(set(numbers)):
        if out and x == out[-1][1] + 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return out


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict = {}
        for ride, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(ride, []).append(at)
        rows = [(ride, *run) for ride, numbers in held.items() for run in runs(numbers)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = [batch.schema.field(0).type, pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["ride_id", "first", "last"])


class _Gaps(StatefulProcessor):
    """State of a ride: the runs of numbers it has, by their first number."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "first bigint", "last bigint")

    def handleInputRows(self, key, rows, timerValues):
        old = {k[0]: v[0] for k, v in self.runs.iterator()}
        joined: list[list[int]] = []
        for first, last in sorted([*old.items(), *((r["first"], r["last"]) for r in rows)]):
            if joined and first <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], last)
            else:
                joined.append([first, last])
        new = dict(joined)
        for first in old.keys() - new.keys():
            self.runs.removeKey((first,))
        for first, last in new.items():
            if old.get(first) != last:
                self.runs.updateValue((first,), (last,))
        was, now = self._between(sorted(old.items())), self._between(joined)
        for change, gaps in (("closed", was - now), ("open", now - was)):
            for first, last in sorted(gaps):
                yield Row(ride_id=key[0], gap_from=first, gap_to=last, change=change)

    def _between(self, parts) -> set[tuple[int, int]]:
        return {(a[1] + 1, b[0] - 1) for a, b in zip(parts, parts[1:], strict=False)}

    def close(self) -> None:
        pass


def ride_gaps(points: DataFrame) -> DataFrame:
    """Ranges of point numbers that a ride misses, as they open and close: ride_id, gap_from, gap_to, change.

    A gap lies between points that came. One that is filled in part is closed and what is left of it opened. Each task
    joins the numbers of its rows to runs first; the state is one entry per run. ``open_gaps`` reads the log.
    """
    kind = dict(points.dtypes)["ride_id"]
    rows = points.filter(F.col("point_idx").isNotNull()).select("ride_id", F.col("point_idx").cast("bigint").alias("point_idx"))
    parts = rows.mapInArrow(_run_rows, f"ride_id {kind}, first bigint, last bigint")
    return each_key(parts, "ride_id", _Gaps(), f"ride_id {kind}, gap_from bigint, gap_to bigint, change string", "None")


def open_gaps(log: DataFrame) -> DataFrame:
    """Gaps that were opened and not closed since."""
    step = F.when(F.col("change") == "open", 1).otherwise(-1)
    return log.groupBy("ride_id", "gap_from", "gap_to").agg(F.sum(step).alias("_n")).filter("_n > 0").drop("_n")


# --- trails by arrival ---------------------------------------------------------------

class _Trail(StatefulProcessor):
    """State of a ride: the points of its newest batches."""

    def __init__(self, head: int) -> None:
        self.head = head

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.batches = handle.getMapState("batches", "batch_id bigint", "points array<bigint>")

    def _weights(self, held: dict[int, list[int]]) -> dict[tuple[int, int], int]:
        newest = sorted(held, reverse=True)[: self.head]
        return {(b, p): self.head - rank for rank, b in enumerate(newest) for p in held[b]}

    def handleInputRows(self, key, rows, timerValues):
        held = {k[0]: list(v[0]) for k, v in self.batches.iterator()}
        was, old = self._weights(held), {b: len(p) for b, p in held.items()}
        for row in rows:
            held.setdefault(row["batch_id"], []).append(row["message_id"])
        now = self._weights(held)
        kept = {b for b, _ in now}
        for batch in old.keys() - kept:
            self.batches.removeKey((batch,))
        for batch in kept:
            if old.get(batch) != len(held[batch]):
                self.batches.updateValue((batch,), (held[batch],))
        for (batch, point), weight in now.items():
            if was.get((batch, point)) != weight:
                yield Row(ride_id=key[0], batch_id=batch, message_id=point, weight=weight)
        for batch, point in was.keys() - now.keys():
            yield Row(ride_id=key[0], batch_id=batch, message_id=point, weight=0)

    def close(self) -> None:
        pass


def ride_trails(points: DataFrame, head: int = K.HEAD_WEIGHT) -> DataFrame:
    """Weights of the points of a ride's newest ``head`` batches as they change; 0 when a point leaves.

    ``points`` has ride_id, batch_id and message_id, each point once. A point that comes for a batch that is no longer among the newest is
    never shown.
    """
    out = f"ride_id {dict(points.dtypes)['ride_id']}, batch_id bigint, message_id bigint, weight bigint"
    return each_key(points.select("ride_id", "batch_id", "message_id"), "ride_id", _Trail(head), out, "None")


# --- fading without ticks ---------------------------------------------------------------

class _Fading(StatefulProcessor):
    """State of a ride: the arrival times of its batches that still weigh, up to when their changes were told, one timer."""

    def __init__(self, head: int, fadeout_ms: int, tick_ms: int) -> None:
        self.head, self.fadeout_ms, self.tick_ms = head, fadeout_ms, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getListState("live", "at_ms bigint, weight bigint, fades_ms bigint")
        self.told = handle.getValueState("told", "until_ms bigint, timer_ms bigint")

    def _next(self, points: list[list[int]]) -> int | None:
        """When the next point loses weight by itself."""
        return min((p[2] for p in points), default=None)

    def _fade(self, key, points: list[list[int]], until: int) -> Iterator[Row]:
        """The changes before ``until``, in order; what has no weight left goes."""
        while (now := self._next(points)) is not None and now < until:
            for p in points:
                if p[2] == now:
                    p[1], p[2] = p[1] - 1, now + self.tick_ms
                    yield Row(ride_id=key[0], batch_ms=p[0], at_ms=now, weight=p[1])
            points[:] = [p for p in points if p[1] > 0]

    def _arrive(self, key, points: list[list[int]], now: int) -> Iterator[Row]:
        """A batch that comes now weighs the others down; those that it is the first to overtake begin to fade."""
        for p in points:
            loss = 1
            if p is points[-1] and p[2] > now:  # overtaken before its age told: its ticks begin here
                p[2] = now + self.tick_ms
            elif p[2] == now:  # a tick of its own at the same instant
                loss, p[2] = 2, now + self.tick_ms
            p[1] = max(0, p[1] - loss)
            yield Row(ride_id=key[0], batch_ms=p[0], at_ms=now, weight=p[1])
        points[:] = [p for p in points if p[1] > 0] + [[now, self.head, now + self.fadeout_ms + self.tick_ms]]
        yield Row(ride_id=key[0], batch_ms=now, at_ms=now, weight=self.head)

    def _load(self) -> list[list[int]]:
        return [list(p) for p in self.live.get()] if self.live.exists() else []

    def _store(self, points: list[list[int]], until: int) -> None:
        if points:
            self.live.put([tuple(p) for p in points])
        else:
            self.live.clear()
        at, was = self._next(points), self.told.get()[1] if self.told.exists() else None
        timer = None if at is None else at + self.tick_ms  # a batch of this very tick may still come
        if was is not None and was != timer:
            self.handle.deleteTimer(was)
        if timer is not None and was != timer:
            self.handle.registerTimer(timer)
        self.told.update((until, timer))

    def handleInputRows(self, key, rows, timerValues):
        points, until = self._load(), self.told.get()[0] if self.told.exists() else None
        for now in sorted({r["batch_ms"] for r in rows}):
            if (until is not None and now < until) or (points and points[-1][0] == now):
                continue  # told already, or a part of the newest batch
            yield from self._fade(key, points, now)
            yield from self._arrive(key, points, now)
            until = now
        self._store(points, until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentWatermarkInMs() // self.tick_ms * self.tick_ms
        points = self._load()
        if expiredTimerInfo.getExpiryTimeInMs() != self.told.get()[1]:
            return
        self.told.update((until, None))
        yield from self._fade(key, points, until)
        self._store(points, until)

    def close(self) -> None:
        pass


def ride_fading(
    points: DataFrame, head: int = K.HEAD_WEIGHT, fadeout_ms: int = K.FADEOUT_MS, tick_ms: int = K.TICK_MS
) -> DataFrame:
    """The weight of the points of every (ride, batch) whenever it changes: ride_id, batch_ms, at_ms, weight, 0 at the end.

    A batch weighs ``head`` when it comes, one less with each later batch of its ride, and one less with every tick since it was
    overtaken or has reached the fade-out age. Nothing is done at ticks at which a ride does not change: it has a single timer, at
    its next change. The clock is the arrivals' own; batches come in the order of their arrival.
    """
    kind = dict(points.dtypes)["ride_id"]
    batches = points.select("ride_id", (F.col("batch_id") * tick_ms).alias("batch_ms"), "arrival_ms")
    timed = batches.withColumn("event_ts", F.timestamp_millis("arrival_ms")).withWatermark("event_ts", "0 seconds")
    out = f"ride_id {kind}, batch_ms bigint, at_ms bigint, weight bigint"
    return each_key(timed.select("ride_id", "batch_ms", "event_ts"), "ride_id", _Fading(head, fadeout_ms, tick_ms), out, "EventTime")


# --- the limit of the cull ---------------------------------------------------------------

class _Limits(StatefulProcessor):
    """State: per arrival tick the greatest weight that came, while it is heavy; the last tick told; one timer."""

    def __init__(self, share: int, fadeout_ms: int, tick_ms: int) -> None:
        self.share, self.fadeout_ms, self.tick_ms = share, fadeout_ms, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heavy = handle.getMapState("heavy", "at_ms bigint", "weight bigint")
        self.told = handle.getValueState("told", "tick_ms bigint, timer_ms bigint")

    def _weight(self, at: int, weight: int, now: int) -> int:
        for _ in range((now - at) // self.tick_ms - self.fadeout_ms // self.tick_ms):
            weight = 4 * weight // 5
        return weight

    def _tell(self, held: dict[int, int], told: int, upto: int) -> Iterator[Row]:
        """The limits of the ticks after ``told`` up to ``upto``; a tick looks at the weights of the tick before."""
        tick = told
        while held and tick < upto:
            tick = max(tick, min(held)) + self.tick_ms
            if tick > upto:
                break
            weights = {at: self._weight(at, w, tick - self.tick_ms) for at, w in held.items() if at < tick}
            for at in [at for at, w in weights.items() if w < self.share]:
                held.pop(at), weights.pop(at)
            if weights:
                yield Row(as_of_ms=tick, limit=max(weights.values()) // self.share)

    def _run(self, fresh: dict[int, int], upto: int) -> Iterator[Row]:
        """Ticks go on to ``upto``, or to the newest of what came."""
        held = {k[0]: v[0] for k, v in self.heavy.iterator()}
        known, (told, was) = set(held), self.told.get() if self.told.exists() else (0, None)
        for at in sorted(fresh):
            yield from self._tell(held, told, at)
            told = max(told, at)
            held[at] = max(held.get(at, 0), fresh[at])
        yield from self._tell(held, told, upto)
        told = max(told, upto)
        for at in known - held.keys():
            self.heavy.removeKey((at,))
        for at in held.keys() & fresh.keys() | held.keys() - known:
            self.heavy.updateValue((at,), (held[at],))
        timer = told + self.tick_ms if held else None
        if was is not None and was != timer:
            self.handle.deleteTimer(was)
        if timer is not None and timer != was:
            self.handle.registerTimer(timer)
        self.told.update((told, timer))

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict[int, int] = {}
        for row in rows:
            fresh[row["at_ms"]] = max(fresh.get(row["at_ms"], 0), row["weight"])
        yield from self._run(fresh, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        told, timer = self.told.get()
        if expiredTimerInfo.getExpiryTimeInMs() == timer:
            self.told.update((told, None))
            yield from self._run({}, timerValues.getCurrentWatermarkInMs() // self.tick_ms * self.tick_ms)

    def close(self) -> None:
        pass


def _heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[int, int] = {}
        for at, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[at] = max(held.get(at, 0), weight)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], ["at_ms", "weight"])


def cull_limits(
    cells: DataFrame, share: int = K.CULL_SHARE, head: int = K.HEAD_WEIGHT, fadeout_ms: int = K.GROUP_FADEOUT_MS, tick_ms: int = K.TICK_MS
) -> DataFrame:
    """as_of_ms, limit: for every tick that culls anything, the weight up to which points go, on a stream of counted cells.

    ``cells`` has ``ntaxis`` and ``arrival_ms`` (whole ticks), in the order of arrival. The limit is a share of the heaviest cell before
    the tick's fade. Each task hands on the greatest weight per arrival tick, and only weights of ``share`` or more, so the
    one key of all cells holds an entry per tick for a few seconds, however many cells there are.
    """
    weights = cells.select(F.col("arrival_ms").alias("at_ms"), (F.col("ntaxis") * head).alias("weight")).filter(F.col("weight") >= share)
    parts = weights.mapInArrow(_heaviest, "at_ms bigint, weight bigint")
    timed = parts.withColumn("event_ts", F.timestamp_millis("at_ms")).withWatermark("event_ts", "0 seconds").withColumn("all", F.lit(0))
    return timed.groupBy("all").transformWithState(
        statefulProcessor=_Limits(share, fadeout_ms, tick_ms),
        outputStructType="as_of_ms bigint, limit bigint",
        outputMode="Update",
        timeMode="EventTime",
    )
