"""The nine ride jobs as DataFrame -> DataFrame functions, with the usual constants as defaults.

``max_timestamp``, ``count_cells``, ``run_rate`` and the row-wise jobs work unchanged on a
batch table and on a stream with a watermark on ``event_ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators import elementwise as E
from meterline.operators import lateness as L
from meterline.operators import sessions
from meterline.operators import windows as W


def all_rides(rides: DataFrame) -> DataFrame:
    """Every point, through the three row-wise forms in turn."""
    once = E.each_row(rides)
    again = E.map_rows(once, lambda df: [F.col(c) for c in df.columns])
    return E.flat_map_rows(again, lambda row: F.array(row))


def filter_box(rides: DataFrame, **limits: float) -> DataFrame:
    return E.box_filter(rides, **limits)


def filter_prefix(rides: DataFrame, prefix: str = K.DEBUG_PREFIX) -> DataFrame:
    return E.prefix_filter(rides, prefix)


def max_timestamp(rides: DataFrame, width_us: int = K.CLOCK_WINDOW_US) -> DataFrame:
    """Greatest payload time per event-time window."""
    out = W.tumbling(rides, width_us, [], F.max(F.unix_millis("timestamp")).alias("max_ts_ms"))
    return out.withColumn("timestamp", S.ms_to_iso(F.col("max_ts_ms")))


def count_cells(rides: DataFrame, width_us: int = K.COUNT_WINDOW_US, edge: float = K.CELL_EDGE) -> DataFrame:
    """Points per grid cell and window. Every point counts, also several of one ride."""
    cells = E.with_cell(rides.select("event_ts", "latitude", "longitude"), edge)
    return W.tumbling(cells, width_us, ["latitude", "longitude"], F.count("*").alias("ntaxis"))


def run_rate(
    rides: DataFrame, width_us: int = K.RATE_WINDOW_US, slide_us: int = K.RATE_SLIDE_US, two_stage: bool = True
) -> DataFrame:
    return W.sliding_money(
        rides, width_us, slide_us, "meter_increment", "dollar_run_rate_per_minute", two_stage=two_stage
    )


def window_turnover(rides: DataFrame, width_us: int = K.TURNOVER_WINDOW_US) -> DataFrame:
    """Turnover per window from whatever rows reach it (batch, or a stream's on-time result)."""
    out = W.tumbling(rides, width_us, [], *W.money_aggs("meter_increment"))
    return out.select(
        "window_start_us",
        S.money_value(F.col("hi"), F.col("lo")).alias("dollar_turnover"),
        S.window_minutes(F.col("window_start_us")).alias("dollar_window"),
    )


def exact_turnover(rides: DataFrame) -> DataFrame:
    """Final turnover per window from arrival order: on-time and late rows, not the dropped ones."""
    final = L.final_turnover(L.classified_turnover(rides))
    return final.withColumn("dollar_window", S.window_minutes(F.col("window_start_us")))


def turnover_panes(rides: DataFrame) -> DataFrame:
    return L.turnover_panes(L.classified_turnover(rides))


def latest_points(rides: DataFrame, gap_us: int = K.LATEST_GAP_US) -> DataFrame:
    return _iso(sessions.latest_per_session(E.ride_points(rides), gap_us))


def pickup_points(rides: DataFrame, gap_us: int = K.PICKUP_GAP_US) -> DataFrame:
    return _iso(sessions.pickup_per_session(E.ride_points(rides), gap_us))


def _iso(points: DataFrame) -> DataFrame:
    return points.withColumn("timestamp", S.ms_to_iso(F.col("ts_ms")))
