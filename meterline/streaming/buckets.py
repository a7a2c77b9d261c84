"""Keyed state by the bucket: the states of many keys are read and written together.

A call to the state store costs a worker far more than the work on a key that has a few rows. Keys are therefore dealt to
buckets by their hash; what a bucket holds is loaded once per micro-batch, a processor made for one key meets its keys
in turn, and the bucket has one timer, the first one of its keys.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the state classes travel to the workers by value, see panes
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of the keys of a stream. It goes with a checkpoint and must stay as it is.
BUCKETS = 1024
_TIMERS = ""


class _Value:
    """A value of the key at hand."""

    def __init__(self, held: _Held, name: str) -> None:
        self.held, self.name = held, name

    def exists(self) -> bool:
        return self.name in self.held.state

    def get(self):
        return self.held.state.get(self.name)

    def update(self, value) -> None:
        self.held.state[self.name] = tuple(value)

    def clear(self) -> None:
        self.held.state.pop(self.name, None)


class _List(_Value):
    def get(self) -> Iterator[tuple]:
        return iter(self.held.state.get(self.name, ()))

    def put(self, values) -> None:
        self.held.state[self.name] = [tuple(v) for v in values]


class _Map(_Value):
    def iterator(self) -> Iterator[tuple]:
        return iter(list(self.held.state.get(self.name, {}).items()))

    def updateValue(self, key, value) -> None:
        self.held.state.setdefault(self.name, {})[tuple(key)] = tuple(value)

    def removeKey(self, key) -> None:
        self.held.state.get(self.name, {}).pop(tuple(key), None)


class _Held:
    """What a processor takes for its handle: the state of the key at hand, in memory."""

    def __init__(self) -> None:
        self.state: dict = {}

    def getValueState(self, name: str, schema: str) -> _Value:
        return _Value(self, name)

    def getListState(self, name: str, schema: str) -> _List:
        return _List(self, name)

    def getMapState(self, name: str, key: str, value: str) -> _Map:
        return _Map(self, name)

    def registerTimer(self, at: int) -> None:
        self.state.setdefault(_TIMERS, set()).add(at)

    def deleteTimer(self, at: int) -> None:
        self.state.get(_TIMERS, set()).discard(at)


class _Expired:
    def __init__(self, at: int) -> None:
        self.at = at

    def getExpiryTimeInMs(self) -> int:
        return self.at


class _Bucket(StatefulProcessor):
    """State of a bucket: the states of its keys, and the timer that is set."""

    def __init__(self, each: StatefulProcessor, key: str) -> None:
        self.each, self.key = each, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, _Held()
        self.kept = handle.getValueState("kept", "states binary, timer_ms bigint")
        self.each.init(self.held)

    def _load(self) -> tuple[dict, int | None]:
        row = self.kept.get()
        return (pickle.loads(bytes(row[0])), row[1]) if row is not None else ({}, None)

    def _store(self, states: dict, was: int | None, fired: int | None = None) -> None:
        states = {name: state for name, state in states.items() if any(state.values())}
        timer = min((at for state in states.values() for at in state.get(_TIMERS, ())), default=None)
        if timer is not None and timer == fired:  # that one goes when it has been handled
            timer += 1
        if was is not None and was != timer:
            self.handle.deleteTimer(was)
        if timer is not None and was != timer:
            self.handle.registerTimer(timer)
        if states:
            self.kept.update((pickle.dumps(states, protocol=5), timer))
        else:
            self.kept.clear()

    def handleInputRows(self, key, rows, timerValues):
        states, was = self._load()
        by_key: dict = {}
        for row in rows:
            by_key.setdefault(row[self.key], []).append(row)
        for name, some in by_key.items():
            self.held.state = states.setdefault(name, {})
            yield from self.each.handleInputRows((name,), iter(some), timerValues)
        self._store(states, was)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        states, was = self._load()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if fired != was:
            return
        now = timerValues.getCurrentWatermarkInMs()
        for name, state in states.items():
            self.held.state = state
            for at in sorted(t for t in state.get(_TIMERS, ()) if t <= now):
                if at in state[_TIMERS]:
                    state[_TIMERS].discard(at)
                    yield from self.each.handleExpiredTimer((name,), timerValues, _Expired(at))
        self._store(states, None, fired)

    def close(self) -> None:
        self.each.close()


def each_key(rows: DataFrame, key: str, each: StatefulProcessor, out: str, time_mode: str) -> DataFrame:
    """What ``each`` makes of every key's rows (update mode), as if ``rows`` were grouped by ``key``.

    ``each`` may hold values, lists and maps, and set timers; keys are plain values such as texts and whole numbers. What it
    keeps of a key should be small, as the states of a bucket are in memory together.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    return dealt.groupBy("_bucket").transformWithState(
        statefulProcessor=_Bucket(each, key), outputStructType=out, outputMode="Update", timeMode=time_mode
    )
