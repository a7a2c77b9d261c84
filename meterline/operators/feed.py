"""Views of the message feed: routing, rates, clocks, boards, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.aggs import last_value, upsert_latest
from meterline.operators.duplicates import duplicates_per_batch
from meterline.operators.joins import salted_join
from meterline.operators.scan import exclusive_scan, last_n, running_count

# --- fixed values: message kinds and the key that tells each ---
KINDS = {
    "ride": "ride_id",
    "cell": "ntaxis",
    "rate": "dollar_run_rate_per_minute",
    "pane": "dollar_turnover",
    "clock": "timestamp",
}


def route_messages(opened: DataFrame, fields: str = "fields") -> DataFrame:
    """One row per message and kind it belongs to; kinds go by key presence and may overlap."""
    present = [F.when(F.map_contains_key(fields, key), F.lit(kind)) for kind, key in KINDS.items()]
    kinds = F.filter(F.array(*present), lambda k: k.isNotNull())
    return opened.withColumn("kind", F.explode(kinds))


# --- duplicates and feed health ----------------------------------------------

def feed_batches(deliveries: DataFrame, feed: str = "feed_id", batch_ms: int = K.TICK_MS) -> DataFrame:
    """Messages and duplicates per feed and pull batch."""
    return duplicates_per_batch(deliveries, batch_ms, (feed,))


def data_rate(messages: Column, span_ms: Column) -> Column:
    """Points per second; one decimal below 1, whole above. A zero span counts as one second."""
    seconds = F.when(span_ms == 0, F.lit(1.0)).otherwise(span_ms / F.lit(1000.0))
    rate = S.one_decimal(messages / seconds)
    return F.when(rate >= 1, S.round_half_up(rate).cast("double")).otherwise(rate)


def health_status(rate: Column, idle_ms: Column, duplicates: Column, saturated_share: Column) -> Column:
    return (
        F.when((rate == 0) | (idle_ms > K.SILENT_AFTER_MS), F.lit("none"))
        .when(duplicates > 0, F.lit("severe"))
        .when(saturated_share > K.SATURATED_SHARE, F.lit("overload"))
        .otherwise(F.lit("ok"))
    )


def feed_health(
    batches: DataFrame,
    feed: str = "feed_id",
    batch_ms: int = K.TICK_MS,
    pull_size: int = K.PULL_SIZE,
    n: int = K.HEALTH_BATCHES,
) -> DataFrame:
    """Rate and overload status over the last ``n`` batches, after each batch.

    ``idle_ms`` is the pause before the batch and ``was_silent`` tells whether that pause
    was long enough to show "no data". The status itself is taken as the batch arrives.
    """
    chunked = batches.withColumns(
        {
            "batch_ms": F.col("batch_id") * batch_ms,
            "saturated": (F.col("n_messages") == pull_size).cast("bigint"),
            "_chunk": F.shiftright("batch_id", 14),
            "_one": F.lit(1).cast("bigint"),
        }
    )
    indexed = exclusive_scan(
        chunked, [feed], ["_chunk", "batch_id"], {"_idx": ("sum", "_one"), "_before": ("max", "batch_ms")}
    ).drop("_chunk", "_one")
    framed = last_n(
        indexed,
        [feed],
        "_idx",
        n,
        sums={"messages": "n_messages", "duplicates": "n_duplicates", "full": "saturated"},
        firsts={"oldest_ms": "batch_ms"},
    )
    idle = F.col("batch_ms") - F.col("_before")
    rate = data_rate(F.col("messages"), F.col("batch_ms") - F.col("oldest_ms"))
    share = F.col("full") / F.col("rows_in_frame")
    return framed.select(
        feed,
        "batch_id",
        "n_messages",
        "n_duplicates",
        rate.alias("data_rate"),
        idle.alias("idle_ms"),
        F.coalesce(idle > K.SILENT_AFTER_MS, F.lit(True)).alias("was_silent"),
        health_status(rate, F.lit(0), F.col("duplicates"), share).alias("status"),
    )


def health_now(health: DataFrame, now_ms: Column, feed: str = "feed_id", batch_ms: int = K.TICK_MS) -> DataFrame:
    """Newest status per feed; "none" once the newest batch is too old."""
    newest = upsert_latest(health, [feed], "batch_id")
    idle = now_ms - F.col("batch_id") * batch_ms
    status = F.when(idle > K.SILENT_AFTER_MS, F.lit("none")).otherwise(F.col("status"))
    return newest.withColumn("status", status)


# --- moving average of bundle sizes --------------------------------------------

def bundle_average(cells: DataFrame, n: int = K.BUNDLE_ROWS) -> DataFrame:
    """Average ``ntaxis`` of the last ``n`` cells after each cell, by window, latitude, longitude.

    A cell's place in the order is a running count over (hour, window, latitude) groups; one
    latitude band has at most 360 / edge cells.
    """
    leveled = cells.withColumn("_hour", S.floor_div(F.col("window_start_us"), 3_600_000_000))
    levels = ["_hour", "window_start_us", "latitude", "longitude"]
    indexed = running_count(leveled, [], levels, "cell_index").drop("_hour")
    framed = last_n(indexed, [], "cell_index", n, sums={"_sum": "ntaxis"})
    return framed.withColumn("avg_ntaxis", F.col("_sum") / F.col("rows_in_frame")).drop("_sum", "rows_in_frame")


# --- clocks, boards -------------------------------------------------------------

def data_clock(points: DataFrame) -> DataFrame:
    """Greatest payload time seen up to and with each batch."""
    per_batch = points.groupBy("batch_id").agg(F.max("ts_ms").alias("batch_max_ms"))
    leveled = per_batch.withColumn("_hour", S.floor_div(F.col("batch_id"), 3_600_000 // K.TICK_MS))
    seen = exclusive_scan(leveled, [], ["_hour", "batch_id"], {"_seen": ("max", "batch_max_ms")})
    clock = F.greatest(F.col("_seen"), F.col("batch_max_ms"))
    return seen.select("batch_id", clock.alias("clock_ms"), S.ms_to_iso(clock).alias("clock"))


def display_state(timing: Column) -> dict[str, Column]:
    """How a pane is shown."""
    state = F.when(timing == K.EARLY, "incomplete").when(timing == K.LATE, "corrected").otherwise("")
    note = F.when(timing == K.EARLY, "(processing)").when(timing == K.LATE, "(updated)").otherwise("")
    return {"state": state, "note": note}


def turnover_board(panes: DataFrame, order: str = "pane_order") -> DataFrame:
    """The newest pane of every window, with its display state and text."""
    newest = upsert_latest(panes, ["dollar_window"], order)
    return newest.withColumns(display_state(F.col("dollar_timing"))).withColumn(
        "text", F.concat_ws(" ", "note", S.us_currency(F.col("dollar_turnover")))
    )


def latest_run_rate(rates: DataFrame) -> DataFrame:
    return last_value(rates, "dollar_run_rate_per_minute", "window_end_us").withColumn(
        "text", S.us_currency(F.col("dollar_run_rate_per_minute"))
    )


# --- ride completeness ------------------------------------------------------------

def point_marks(points: DataFrame) -> DataFrame:
    """Per point: offset from the ride's first-seen point, and whether the ride was done before it.

    Both need just one number or key per ride, found by aggregation; the points then look
    it up by (ride, salt). The drop-off itself does not count as received after done.
    """
    seen = F.struct("arrival_ms", "message_id")
    counted = points.filter(F.col("point_idx").isNotNull())
    per_ride = counted.groupBy("ride_id").agg(
        F.min_by("point_idx", seen).alias("origin"),
        F.min(F.when(F.col("ride_status") == K.STATUS_DROPOFF, seen)).alias("done_at"),
    )
    looked_up = salted_join(counted, per_ride, ["ride_id"], "message_id")
    return looked_up.withColumns(
        {
            "offset": F.col("point_idx") - F.col("origin"),
            "after_done": F.coalesce(seen > F.col("done_at"), F.lit(False)),
        }
    )


def ride_completeness(points: DataFrame) -> DataFrame:
    """Received, missing and after-done points per ride.

    Distinct offsets are counted in two steps, by (ride, offset) and then by ride, so a long
    ride is spread by offset first.
    """
    per_offset = point_marks(points).groupBy("ride_id", "offset").agg(
        F.count("*").alias("n"),
        F.sum(F.col("after_done").cast("bigint")).alias("late"),
        F.max(F.col("ride_status") == K.STATUS_DROPOFF).alias("done"),
        F.max("origin").alias("origin"),
    )
    rides = per_offset.groupBy("ride_id").agg(
        F.max("origin").alias("origin"),
        F.sum("n").alias("n_points"),
        F.count("*").alias("n_offsets"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.max("done").alias("done"),
        F.sum("late").alias("n_after_done"),
    )
    return rides.withColumn("n_missing", F.col("max_offset") - F.col("min_offset") + 1 - F.col("n_offsets"))
