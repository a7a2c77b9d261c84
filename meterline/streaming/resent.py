"""Re-sent messages on a stream: the exact 30-second memory as keyed state.

``dropDuplicatesWithinWatermark`` counts its delay twice and depends on the cut into micro-batches; here the state of an
id is the one number that the rule needs, the arrival that made it known.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline.streaming.buckets import each_key

# the state class travels to the workers by value, see panes
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.drop_duplicates()


class _Memory(StatefulProcessor):
    """State of one id: the arrival that made it known."""

    def __init__(self, memory_ms: int) -> None:
        self.memory_ms = memory_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "arrival_ms bigint")

    def handleInputRows(self, key, rows, timerValues):
        start = self.known.get()[0] if self.known.exists() else None
        before = start
        for arrival in sorted({row["arrival_ms"] for row in rows}):
            if start is None or arrival > start + self.memory_ms:
                start = arrival
                yield Row(id=key[0], arrival_ms=start)
        if start != before:
            if before is not None:
                self.handle.deleteTimer(before + self.memory_ms)
            self.known.update((start,))
            self.handle.registerTimer(start + self.memory_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


def starts(deliveries: DataFrame, memory_ms: int, key: str, delay: str) -> DataFrame:
    """The deliveries that make their id known; ids are passed on as they are."""
    kind = dict(deliveries.dtypes)[key]
    arrivals = (
        deliveries.select(F.col(key).alias("id"), "arrival_ms")
        .mapInPandas(_distinct, f"id {kind}, arrival_ms bigint")
        .withColumn("event_ts", F.timestamp_millis("arrival_ms"))
        .withWatermark("event_ts", delay)
    )
    out = each_key(arrivals, "id", _Memory(memory_ms), f"id {kind}, arrival_ms bigint", "EventTime")
    return out.select(F.col("id").alias(key), "arrival_ms")
