"""Every row of a stream with its lateness class: on time, late, and the dropped ones that built-in operators lose.

Spark's own operators drop a late row without a trace, because they see the event-time column. Here the watermark is
taken from that column and the column left behind, so all rows reach the state function, which reads the
watermark of its micro-batch and judges them by it. Nothing is kept between micro-batches.
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
from meterline.operators.windows import micros

# the state classes travel to the workers by value, see panes
cloudpickle.register_pickle_by_value(sys.modules[__name__])
ON_TIME, LATE, DROPPED = K.ON_TIME, K.LATE, K.DROPPED

#: Groups that the rows of a micro-batch are dealt to; a hot window or ride is spread over all of them.
SPREAD = 64


class _Judge(StatefulProcessor):
    """No state: a row's class follows from the end of its window and the watermark of the micro-batch."""

    def __init__(self, width_us: int, lateness_us: int, fields: tuple[str, ...]) -> None:
        self.width_us, self.lateness_us, self.fields = width_us, lateness_us, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        spark_ms = timerValues.getCurrentWatermarkInMs()
        mark = spark_ms * 1000 if spark_ms > 0 else None  # 0 until the first data
        for row in rows:
            end = row["window_start_us"] + self.width_us
            if mark is None or end > mark:
                label = ON_TIME
            else:
                label = LATE if end + self.lateness_us > mark else DROPPED
            yield Row(**{f: row[f] for f in self.fields}, watermark_us=mark, lateness=label)

    def close(self) -> None:
        pass


def _judged(rows: DataFrame, group: str, fields: dict[str, str], width_us: int, lateness_us: int) -> DataFrame:
    out = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    return rows.groupBy(group).transformWithState(
        statefulProcessor=_Judge(width_us, lateness_us, tuple(fields)),
        outputStructType=f"{out}, watermark_us bigint, lateness string",
        outputMode="Update",
        timeMode="EventTime",
    )


def _windows(rides: DataFrame, width_us: int, delay_us: int) -> DataFrame:
    timed = rides.withWatermark("event_ts", micros(delay_us))
    return timed.withColumn("window_start_us", S.floor_div(F.unix_micros("event_ts"), width_us) * width_us)


def label_rows(
    rides: DataFrame,
    columns: tuple[str, ...] = ("message_id",),
    width_us: int = K.TURNOVER_WINDOW_US,
    lateness_us: int = K.TURNOVER_LATENESS_US,
    delay_us: int = 0,
) -> DataFrame:
    """``columns`` of every row with its window, the watermark it met and its class (update mode)."""
    kinds = dict(rides.dtypes)
    fields = {c: kinds[c] for c in columns} | {"window_start_us": "bigint"}
    spread = F.pmod(F.xxhash64(*columns), F.lit(SPREAD)).alias("spread")
    rows = _windows(rides, width_us, delay_us).select(spread, *fields)
    return _judged(rows, "spread", fields, width_us, lateness_us)


_SUMS = {"window_start_us": "bigint", "n_points": "bigint", "hi": "bigint", "lo": "bigint"}


def _by_window(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if len(rows):
            sums = rows.assign(n_points=1).groupby("window_start_us", as_index=False)[["n_points", "hi", "lo"]].sum()
            yield sums.astype("int64")


def label_windows(
    rides: DataFrame,
    amount: str = "meter_increment",
    width_us: int = K.TURNOVER_WINDOW_US,
    lateness_us: int = K.TURNOVER_LATENESS_US,
    delay_us: int = 0,
) -> DataFrame:
    """Points and money per window and class, as they come (update mode): parts that add up to all rows of the stream.

    Rows are summed up by window in each task first; all rows of a window in one micro-batch are of one class. A row
    without an amount counts as a point.
    """
    rows = _windows(rides, width_us, delay_us).select(
        "window_start_us",
        F.coalesce(S.money_hi(F.col(amount)), F.lit(0)).cast("bigint").alias("hi"),
        F.coalesce(S.money_lo(F.col(amount)), F.lit(0)).cast("bigint").alias("lo"),
    )
    sums = rows.mapInPandas(_by_window, ", ".join(f"{k} {v}" for k, v in _SUMS.items()))
    return _judged(sums, "window_start_us", _SUMS, width_us, lateness_us)


def class_totals(parts: DataFrame) -> DataFrame:
    """Points and money per window and class from the parts that came so far."""
    return parts.groupBy("window_start_us", "lateness").agg(
        F.sum("n_points").alias("n_points"), S.money_value(F.sum("hi"), F.sum("lo")).alias("dollars")
    )
