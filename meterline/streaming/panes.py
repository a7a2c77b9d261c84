"""Labelled panes: EARLY, ON_TIME and LATE results of open windows and sessions.

Spark has one watermark for "window complete" and "row too late"; these jobs need two
points in time. The watermark delay is therefore enlarged by the lateness and the window
width (or the gap), which keeps every live row, and the state functions work with
``watermark + that enlargement``. They are the only Python state in the package.

Before the keyed state, each task reduces its Arrow batches to one row per key and slot, so
a key that holds a large share of a micro-batch reaches its state as a handful of rows.
An EARLY pane is fired by each micro-batch that changes a window; the early delay of
the jobs is the processing-time trigger.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators import elementwise as E
from meterline.operators.windows import micros
from meterline.streaming.buckets import each_key

# The state classes travel to the workers by value, so a cluster needs no copy of this
# package. They may therefore use nothing of it but these plain names.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
EARLY, ON_TIME, LATE, PICKUP = K.EARLY, K.ON_TIME, K.LATE, K.STATUS_PICKUP

# --- turnover per fixed window ---------------------------------------------------

_SUMS = "window_start_us bigint, last_us bigint, hi bigint, lo bigint"
_PANE_OUT = "window_start_us bigint, dollar_timing string, hi bigint, lo bigint"


#: Rows that a task folds at a time at most; a task whose micro-batch has fewer gives one row per window.
FOLD = 100_000


def _sum_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    how = {"last_us": "max", "hi": "sum", "lo": "sum"}
    held: list[pd.DataFrame] = []
    for rows in batches:
        held.append(rows.groupby("window_start_us", as_index=False).agg(how))
        if sum(map(len, held)) > FOLD:
            yield pd.concat(held).groupby("window_start_us", as_index=False).agg(how)
            held.clear()
    if held:
        yield pd.concat(held).groupby("window_start_us", as_index=False).agg(how)


class _TurnoverPanes(StatefulProcessor):
    """State of one window: the money sum so far and whether ON_TIME was fired."""

    def __init__(self, width_us: int, lateness_us: int) -> None:
        self.width_ms = width_us // 1000
        self.lateness_ms = lateness_us // 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "hi bigint, lo bigint, fired boolean")

    def _clock(self, spark_ms: int) -> int | None:
        # the engine's watermark is 0 until the first data
        return spark_ms + self.lateness_ms + self.width_ms if spark_ms > 0 else None

    def handleInputRows(self, key, rows, timerValues):
        start_us = key[0]
        end_ms = start_us // 1000 + self.width_ms
        now = self._clock(timerValues.getCurrentWatermarkInMs())
        hi = lo = 0
        for row in rows:
            hi, lo = hi + row["hi"], lo + row["lo"]
        if now is not None and now >= end_ms + self.lateness_ms:
            return  # past the allowed lateness
        known = self.total.exists()
        old_hi, old_lo, fired = self.total.get() if known else (0, 0, False)
        complete = now is not None and now >= end_ms
        if complete and known and not fired:
            # input comes before expired timers: give the on-time pane its own sum first
            yield Row(window_start_us=start_us, dollar_timing=ON_TIME, hi=old_hi, lo=old_lo)
            fired = True
        if not known:
            self.handle.registerTimer(end_ms - self.lateness_ms - self.width_ms)
            self.handle.registerTimer(end_ms - self.width_ms)
        # a window whose first rows are late has no on-time pane
        fired = fired or complete
        hi, lo = old_hi + hi, old_lo + lo
        self.total.update((hi, lo, fired))
        label = LATE if complete else EARLY
        yield Row(window_start_us=start_us, dollar_timing=label, hi=hi, lo=lo)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.total.exists():
            return
        start_us = key[0]
        end_ms = start_us // 1000 + self.width_ms
        now = self._clock(timerValues.getCurrentWatermarkInMs())
        hi, lo, fired = self.total.get()
        if now is not None and now >= end_ms and not fired:
            self.total.update((hi, lo, True))
            yield Row(window_start_us=start_us, dollar_timing=ON_TIME, hi=hi, lo=lo)
        if now is not None and now >= end_ms + self.lateness_ms:
            self.total.clear()

    def close(self) -> None:
        pass


def turnover_panes(
    rides: DataFrame,
    width_us: int = K.TURNOVER_WINDOW_US,
    lateness_us: int = K.TURNOVER_LATENESS_US,
    delay_us: int = 0,
) -> DataFrame:
    """Labelled, accumulating turnover panes of a stream (update mode)."""
    parts = rides.select(
        (S.floor_div(F.unix_micros("event_ts"), width_us) * width_us).alias("window_start_us"),
        F.unix_micros("event_ts").alias("last_us"),
        S.money_hi(F.col("meter_increment")).alias("hi"),
        S.money_lo(F.col("meter_increment")).alias("lo"),
    ).dropna(subset=["hi"])
    sums = (
        parts.mapInPandas(_sum_slots, _SUMS)
        .withColumn("event_ts", F.timestamp_micros("last_us"))
        .withWatermark("event_ts", micros(delay_us + lateness_us + width_us))
    )
    panes = sums.groupBy("window_start_us").transformWithState(
        statefulProcessor=_TurnoverPanes(width_us, lateness_us),
        outputStructType=_PANE_OUT,
        outputMode="Update",
        timeMode="EventTime",
    )
    return panes.select(
        "window_start_us",
        "dollar_timing",
        S.money_value(F.col("hi"), F.col("lo")).alias("dollar_turnover"),
        S.window_minutes(F.col("window_start_us")).alias("dollar_window"),
    )


# --- one point per session ---------------------------------------------------------

_POINT = "ts_ms bigint, message_id bigint, latitude float, longitude float, ride_status string"
_SLOTS = f"ride_id string, slot_us bigint, first_us bigint, last_us bigint, {_POINT}"
_SESSION_STATE = f"first_us bigint, last_us bigint, {_POINT}"
_SESSION_OUT = f"ride_id string, session_start_us bigint, session_end_us bigint, pane_timing string, {_POINT}"
_POINT_FIELDS = ["ts_ms", "message_id", "latitude", "longitude", "ride_status"]


def _pick_slots(latest: bool):
    """Reduce a batch to one row per (ride, second); a second is open at its start, closed at its end.

    Rows are judged late by whole seconds, so all rows of a slot share one fate.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            keys = ["ride_id", "slot_us"]
            spans = rows.groupby(keys, as_index=False).agg(first_us=("event_us", "min"), last_us=("event_us", "max"))
            wanted = rows if latest else rows[rows["ride_status"] == PICKUP]
            ordered = wanted.sort_values(["ts_ms", "message_id"], ascending=[not latest, True], kind="stable")
            points = ordered.drop_duplicates(keys)[keys + _POINT_FIELDS]
            out = spans.merge(points, on=keys, how="left")
            out["ts_ms"] = out["ts_ms"].astype("Int64")
            out["message_id"] = out["message_id"].astype("Int64")
            yield out[["ride_id", "slot_us", "first_us", "last_us", *_POINT_FIELDS]]

    return reduce


class _SessionPanes(StatefulProcessor):
    """State of one ride: its open sessions with their chosen point (few; lateness is zero)."""

    def __init__(self, gap_us: int, latest: bool) -> None:
        self.gap_us = gap_us
        self.latest = latest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", _SESSION_STATE)

    def _better(self, one, other):
        """The point to keep of two (tuples in _POINT order, ts_ms None for no point)."""
        if one[0] is None:
            return other
        if other[0] is None:
            return one
        if self.latest:
            return min(one, other, key=lambda p: (-p[0], p[1]))
        return min(one, other, key=lambda p: (p[0], p[1]))

    def _out(self, ride_id, session, label):
        first, last, point = session
        return Row(
            ride_id=ride_id,
            session_start_us=first,
            session_end_us=last + self.gap_us,
            pane_timing=label,
            **dict(zip(_POINT_FIELDS, point)),
        )

    def _load(self):
        if not self.sessions.exists():
            return []
        return [(s[0], s[1], tuple(s[2:])) for s in self.sessions.get()]

    def _store(self, open_sessions) -> None:
        if not open_sessions:
            self.sessions.clear()
            return
        self.sessions.put([(first, last, *point) for first, last, point in open_sessions])

    def _split(self, all_sessions, spark_ms):
        """Closed and open sessions. The real watermark is the engine's plus one gap."""
        now_us = spark_ms * 1000 + self.gap_us if spark_ms > 0 else None
        closed = [s for s in all_sessions if now_us is not None and s[1] + self.gap_us <= now_us]
        return closed, [s for s in all_sessions if s not in closed]

    def handleInputRows(self, key, rows, timerValues):
        ride_id = key[0]
        spark_ms = timerValues.getCurrentWatermarkInMs()
        closed, current = self._split(self._load(), spark_ms)
        for session in closed:
            if session[2][0] is not None:
                yield self._out(ride_id, session, ON_TIME)
        slots = [
            (r["first_us"], r["last_us"], tuple(r[f] for f in _POINT_FIELDS), True)
            for r in rows
            # the engine's own late filter lags one micro-batch, so a row is judged here
            if spark_ms <= 0 or r["slot_us"] > spark_ms * 1000
        ]
        merged = []
        for first, last, point, fresh in sorted([(*s, False) for s in current] + slots, key=lambda s: s[0]):
            if merged and first - merged[-1][1] < self.gap_us:
                before = merged[-1]
                merged[-1] = (before[0], max(before[1], last), self._better(before[2], point), before[3] or fresh)
            else:
                merged.append((first, last, point, fresh))
        self._store([s[:3] for s in merged])
        # a session has one timer, at its last row; the ones of before that no session has any more go
        was, now = {-(-s[1] // 1000) for s in current}, {-(-s[1] // 1000) for s in merged}
        for at in was - now:
            self.handle.deleteTimer(at)
        for at in now - was:
            self.handle.registerTimer(at)
        for first, last, point, fresh in merged:
            if fresh and point[0] is not None:
                yield self._out(ride_id, (first, last, point), EARLY)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed, still_open = self._split(self._load(), timerValues.getCurrentWatermarkInMs())
        if closed:
            self._store(still_open)
        for session in closed:
            if session[2][0] is not None:
                yield self._out(key[0], session, ON_TIME)

    def close(self) -> None:
        pass


def _session_panes(rides: DataFrame, gap_us: int, delay_us: int, latest: bool) -> DataFrame:
    if gap_us % K.SECOND_US or delay_us % K.SECOND_US:
        raise ValueError("gap and delay are whole seconds")
    points = E.ride_points(rides).withColumn("event_us", F.unix_micros("event_ts"))
    slot_end = F.ceil(F.col("event_us") / F.lit(K.SECOND_US)).cast("bigint") * K.SECOND_US
    slots = (
        points.select("ride_id", slot_end.alias("slot_us"), "event_us", *_POINT_FIELDS)
        .mapInPandas(_pick_slots(latest), _SLOTS)
        .withColumn("event_ts", F.timestamp_micros("slot_us"))
        .withWatermark("event_ts", micros(delay_us + gap_us + K.SECOND_US))
    )
    panes = each_key(slots, "ride_id", _SessionPanes(gap_us, latest), _SESSION_OUT, "EventTime")
    return panes.withColumn("timestamp", S.ms_to_iso(F.col("ts_ms")))


def latest_panes(rides: DataFrame, gap_us: int = K.LATEST_GAP_US, delay_us: int = 0) -> DataFrame:
    """Newest point of each ride session, early and final (update mode)."""
    return _session_panes(rides, gap_us, delay_us, latest=True)


def pickup_panes(rides: DataFrame, gap_us: int = K.PICKUP_GAP_US, delay_us: int = 0) -> DataFrame:
    """Pickup point of each ride session, early and final (update mode)."""
    return _session_panes(rides, gap_us, delay_us, latest=False)
