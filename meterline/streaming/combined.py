"""A combine function of the user's own per session of a stream, with early and final panes.

State of a key: its open sessions, each a span and an accumulator. Each task folds its rows into one accumulator per key
and second before the shuffle, so a key that holds a large share of a micro-batch reaches its state as a few rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline import constants as K
from meterline.operators.combine import HELD, Combine, _arrow, _columns, names, spanned
from meterline.operators.windows import micros
from meterline.streaming.buckets import each_key

# the state classes travel to the workers by value, see panes
cloudpickle.register_pickle_by_value(sys.modules[__name__])
EARLY, ON_TIME = K.EARLY, K.ON_TIME


class _Sessions(StatefulProcessor):
    def __init__(self, gap_us: int, fn: Combine, key: str, early: bool) -> None:
        # plain parts of the function, so that no class of the package has to be there on a worker
        self.gap_us, self.key, self.early = gap_us, key, early
        self.state, self.shown = fn.state, names(fn.state)
        self.out, self.merge, self.extract = names(fn.out), fn.merge, fn.extract

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", self.state)

    def _load(self) -> list[tuple]:
        return [tuple(s) for s in self.sessions.get()] if self.sessions.exists() else []

    def _split(self, sessions: list[tuple], spark_ms: int) -> tuple[list, list]:
        """Closed and open sessions. The real watermark is the engine's plus one gap."""
        now = spark_ms * 1000 + self.gap_us if spark_ms > 0 else None
        closed = [s for s in sessions if now is not None and s[1] + self.gap_us <= now]
        return closed, [s for s in sessions if s not in closed]

    def _out(self, key, session: tuple, label: str) -> Row:
        values = dict(zip(self.out, self.extract(session), strict=True))
        first, last = values.pop("first_us"), values.pop("last_us")
        return Row(**{self.key: key}, session_start_us=first, session_end_us=last + self.gap_us, pane_timing=label, **values)

    def handleInputRows(self, key, rows, timerValues):
        spark_ms = timerValues.getCurrentWatermarkInMs()
        closed, current = self._split(self._load(), spark_ms)
        for session in closed:
            yield self._out(key[0], session, ON_TIME)
        # the engine's own late filter lags one micro-batch, so a row is judged here
        fresh = [tuple(r[n] for n in self.shown) for r in rows if spark_ms <= 0 or r["slot_us"] > spark_ms * 1000]
        joined: list[list] = []
        for session, new in sorted([(s, False) for s in current] + [(s, True) for s in fresh], key=lambda s: s[0][0]):
            if joined and session[0] - joined[-1][0][1] < self.gap_us:
                joined[-1] = [self.merge(joined[-1][0], session), joined[-1][1] or new]
            else:
                joined.append([session, new])
        if joined:
            self.sessions.put([s for s, _ in joined])
        else:
            self.sessions.clear()
        was, now = {-(-s[1] // 1000) for s in current}, {-(-s[1] // 1000) for s, _ in joined}
        for at in was - now:
            self.handle.deleteTimer(at)
        for at in now - was:
            self.handle.registerTimer(at)
        if self.early:
            for session, new in joined:
                if new:
                    yield self._out(key[0], session, EARLY)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed, still = self._split(self._load(), timerValues.getCurrentWatermarkInMs())
        if closed:
            if still:
                self.sessions.put(still)
            else:
                self.sessions.clear()
        for session in closed:
            yield self._out(key[0], session, ON_TIME)

    def close(self) -> None:
        pass


def combine_sessions(
    rides: DataFrame, gap_us: int, fn: Combine, key: str = "ride_id", delay_us: int = 0, early: bool = False
) -> DataFrame:
    """``key``, span, ``pane_timing`` and the fields of ``out`` per session (update mode). Gap and delay are whole seconds.

    With ``early`` every micro-batch that changes a session gives a pane of it; a closed session gives its final one.
    """
    if gap_us % K.SECOND_US or delay_us % K.SECOND_US:
        raise ValueError("gap and delay are whole seconds")
    whole, kind = spanned(fn), dict(rides.dtypes)[key]
    schema = f"{key} {kind}, slot_us bigint, {whole.state}"
    arrow = _arrow(rides.sparkSession.createDataFrame([], schema))
    create, add, limit = whole.create, whole.add, HELD

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                acc = held.get(row[:2])
                held[row[:2]] = add(create() if acc is None else acc, row[2:])
            if len(held) > limit:
                yield _columns([(*k, *v) for k, v in held.items()], arrow)
                held.clear()
        yield _columns([(*k, *v) for k, v in held.items()], arrow)

    event_us = F.unix_micros("event_ts")
    # a second is open at its start and closed at its end, as all its rows are judged late or not together
    slot = F.ceil(event_us / F.lit(K.SECOND_US)).cast("bigint") * K.SECOND_US
    rows = rides.withColumn("event_us", event_us).select(key, slot.alias("slot_us"), *whole.reads)
    timed = rows.mapInArrow(fold, schema).withColumn("event_ts", F.timestamp_micros("slot_us"))
    timed = timed.withWatermark("event_ts", micros(delay_us + gap_us + K.SECOND_US))
    out = f"{key} {kind}, session_start_us bigint, session_end_us bigint, pane_timing string, {fn.out}"
    return each_key(timed, key, _Sessions(gap_us, whole, key, early), out, "EventTime")
