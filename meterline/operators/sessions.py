"""Sessions per ride with half-open windows: rows exactly one gap apart start a new session.

Batch form. Two rows of a ride in one gap-wide slot of time are always less than one gap
apart, so they share a session. Rows are therefore reduced to one partial per (ride, slot)
before the first shuffle, and sessions are found on the slots. A ride has at most
time-span / gap slots, whatever share of the rows it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.aggs import newest_first, oldest_first
from meterline.operators.windows import micros


def session_slots(df: DataFrame, gap_us: int, key: str, *aggs: Column) -> DataFrame:
    slot = S.floor_div(F.col("event_us"), gap_us).alias("slot")
    return df.groupBy(key, slot).agg(
        F.min("event_us").alias("first_us"), F.max("event_us").alias("last_us"), *aggs
    )


def mark_sessions(slots: DataFrame, gap_us: int, key: str) -> DataFrame:
    """Add ``session_start_us`` to every slot."""
    order = Window.partitionBy(key).orderBy("slot")
    before = F.lag("last_us").over(order)
    opens = before.isNull() | (F.col("first_us") - before >= gap_us)
    start = F.when(opens, F.col("first_us"))
    return slots.withColumn("_opens", start).withColumn(
        "session_start_us", F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_opens")


def session_spans(df: DataFrame, gap_us: int, key: str = "ride_id") -> DataFrame:
    slots = session_slots(df, gap_us, key, F.count("*").alias("n"))
    return (
        mark_sessions(slots, gap_us, key)
        .groupBy(key, "session_start_us")
        .agg((F.max("last_us") + gap_us).alias("session_end_us"), F.sum("n").alias("n_points"))
    )


def _point() -> Column:
    return F.struct("latitude", "longitude", "ts_ms", "message_id", "ride_status")


def latest_per_session(points: DataFrame, gap_us: int = K.LATEST_GAP_US) -> DataFrame:
    """Newest point (payload time, then smallest id) of every ride session."""
    slots = session_slots(points, gap_us, "ride_id", F.max_by(_point(), newest_first()).alias("p"))
    by = F.struct(F.col("p.ts_ms"), -F.col("p.message_id"))
    return _finish(mark_sessions(slots, gap_us, "ride_id"), gap_us, F.max_by("p", by))


def pickup_per_session(points: DataFrame, gap_us: int = K.PICKUP_GAP_US) -> DataFrame:
    """First pickup point of every ride session that has one.

    Sessions span all points. The pickup test sits inside the aggregate: filtering
    the rows first would split sessions.
    """
    is_pickup = F.col("ride_status") == K.STATUS_PICKUP
    first = F.min_by(_point(), F.when(is_pickup, oldest_first())).alias("p")
    slots = session_slots(points, gap_us, "ride_id", first)
    by = F.when(F.col("p").isNotNull(), F.struct(F.col("p.ts_ms"), F.col("p.message_id")))
    sessions = _finish(mark_sessions(slots, gap_us, "ride_id"), gap_us, F.min_by("p", by))
    return sessions.filter(F.col("ride_status") == K.STATUS_PICKUP)


def _finish(marked: DataFrame, gap_us: int, pick: Column) -> DataFrame:
    return (
        marked.groupBy("ride_id", "session_start_us")
        .agg((F.max("last_us") + gap_us).alias("session_end_us"), pick.alias("p"))
        .select("ride_id", "session_start_us", "session_end_us", "p.*")
    )


def streaming_sessions(df: DataFrame, gap_us: int, *aggs: Column, key: str = "ride_id") -> DataFrame:
    """Append-mode sessions with the built-in session window.

    That window joins rows exactly one gap apart, so it gets one microsecond less and the
    shown end one more.
    """
    out = df.groupBy(key, F.session_window("event_ts", micros(gap_us - 1))).agg(*aggs)
    rest = [c for c in out.columns if c not in (key, "session_window")]
    return out.select(
        key,
        F.unix_micros("session_window.start").alias("session_start_us"),
        (F.unix_micros("session_window.end") + 1).alias("session_end_us"),
        *rest,
    )
