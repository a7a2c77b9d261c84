"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators import combine, duplicates, elementwise, feed, lateness, sessions, trails
from meterline.operators.scan import ring_statistics as ring_stats
from meterline.operators.scan import running_count
from meterline.plans import datasets, jobs
from meterline.session import prepare
from meterline.sources import rides as R
from meterline.sources import sinks
from meterline.sources.fanout import message_parts
from meterline.streaming import combined, late, union, views
from meterline.streaming import jobs as stream_jobs
from meterline.streaming import panes as stream_panes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HEAT_EVERY_MS = 5000
#: The longest that a ride point of the table is under way; session streams wait so long for late points.
DELAY_US = 480 * K.SECOND_US
DELAY = "480 seconds"
POINT = ["ride_id", "session_start_us", "session_end_us", "latitude", "longitude", "timestamp", "ride_status", "message_id"]


def _register(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a function of the ride table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(R.load_rides(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ride table as a stream in arrival order, in many micro-batches."""
    return stream_jobs.arrival_ordered(R.load_rides(prepare(spark), sf_dir), f"rides {sf_dir}")


def _register_stream(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a function of the ride stream; it is replayed to its end and the written rows come back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stream_jobs.replay(fn(_arriving(spark, sf_dir)), fn.__name__).drop("emit_batch")

    QUERIES[fn.__name__] = run
    return fn


def _widen(df: DataFrame) -> DataFrame:
    """Single-precision positions as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        "ride_id", "message_id", "event_us", F.unix_micros("timestamp").alias("payload_us"), "latitude", "longitude",
        "meter_reading", "meter_increment", "ride_status", "passenger_count", "point_idx", "arrival_ms",
    )


# --- row-wise jobs ---------------------------------------------------------------

@_register
def all_rides(rides: DataFrame) -> DataFrame:
    return _plain(jobs.all_rides(rides))


@_register
def filter_box(rides: DataFrame) -> DataFrame:
    return _plain(jobs.filter_box(rides))


@_register
def filter_prefix(rides: DataFrame) -> DataFrame:
    return _plain(jobs.filter_prefix(rides, "a"))


@_register
def reject_split(rides: DataFrame) -> DataFrame:
    """Every message with its verdict; typed fields for the good ones."""
    judged = R.with_verdict(R.decode_json(datasets.raw_messages(rides)))
    typed = R.typed_fields()
    good = F.col("reject_reason").isNull()
    return judged.select(
        "message_id",
        F.coalesce("reject_reason", F.lit("good")).alias("verdict"),
        F.when(good, typed["latitude"]).alias("latitude"),
        F.when(good, F.unix_millis(typed["timestamp"])).alias("ts_ms"),
        F.when(good, typed["meter_increment"]).alias("meter_increment"),
    )


@_register
def grid_cells(rides: DataFrame) -> DataFrame:
    cells = elementwise.with_cell(rides)
    return cells.select("message_id", "latitude", "longitude")


# --- windowed jobs ---------------------------------------------------------------

@_register
def max_timestamp(rides: DataFrame) -> DataFrame:
    return jobs.max_timestamp(rides)


@_register
def count_cells(rides: DataFrame) -> DataFrame:
    return jobs.count_cells(rides)


@_register
def run_rate(rides: DataFrame) -> DataFrame:
    return jobs.run_rate(rides)


@_register
def run_rate_direct(rides: DataFrame) -> DataFrame:
    return jobs.run_rate(rides, two_stage=False)


@_register
def exact_turnover(rides: DataFrame) -> DataFrame:
    return jobs.exact_turnover(rides)


@_register
def turnover_panes(rides: DataFrame) -> DataFrame:
    return jobs.turnover_panes(rides)


@_register
def lateness_rows(rides: DataFrame) -> DataFrame:
    return lateness.classify_rows(rides).select("message_id", "window_start_us", "watermark_us", "lateness")


@_register
def lateness_classes(rides: DataFrame) -> DataFrame:
    return lateness.class_totals(lateness.classified_turnover(rides))


# --- sessions ----------------------------------------------------------------------

@_register
def latest_points(rides: DataFrame) -> DataFrame:
    return _widen(jobs.latest_points(lateness.in_time(rides, K.LATEST_GAP_US)).select(*POINT))


@_register
def latest_points_minute_gap(rides: DataFrame) -> DataFrame:
    return _widen(jobs.latest_points(lateness.in_time(rides, K.MINUTE_US), K.MINUTE_US).select(*POINT))


@_register
def pickup_points(rides: DataFrame) -> DataFrame:
    return _widen(jobs.pickup_points(lateness.in_time(rides, K.PICKUP_GAP_US)).select(*POINT))


@_register
def session_spans(rides: DataFrame) -> DataFrame:
    return sessions.session_spans(rides, K.PICKUP_GAP_US)


# --- combine functions of the user's own ------------------------------------------

@_register
def combine_latest_points(rides: DataFrame) -> DataFrame:
    """``latest_points`` with a combine function in Python."""
    points = lateness.in_time(elementwise.ride_points(rides), K.LATEST_GAP_US)
    return _shown(combine.combine_sessions(points, K.LATEST_GAP_US, combine.latest_point()))


@_register
def combine_pickup_points(rides: DataFrame) -> DataFrame:
    points = lateness.in_time(elementwise.ride_points(rides), K.PICKUP_GAP_US)
    picked = combine.combine_sessions(points, K.PICKUP_GAP_US, combine.pickup_point())
    return _shown(picked.filter(F.col("ride_status").isNotNull()))


@_register
def combine_ride_totals(rides: DataFrame) -> DataFrame:
    return combine.combine(rides, ["ride_id"], combine.ride_totals())


def _shown(points: DataFrame) -> DataFrame:
    return _widen(points.withColumn("timestamp", S.ms_to_iso(F.col("ts_ms"))).select(*POINT))


# --- feed views ----------------------------------------------------------------------

@_register
def message_topic(rides: DataFrame) -> DataFrame:
    """The messages of five jobs in one table."""
    columns = ["ride_id", "timestamp", "dollar_timing", "ntaxis", "latitude", "longitude"]
    dollars = ["dollar_run_rate_per_minute", "dollar_turnover", "dollar_window"]
    return datasets.topic(rides).select(*columns, *dollars)


@_register
def route_messages(rides: DataFrame) -> DataFrame:
    opened = R.open_envelopes(R.seal_envelopes(datasets.topic(rides)))
    field = lambda name: F.col("fields")[name]
    doubles = ["latitude", "longitude", "dollar_run_rate_per_minute", "dollar_turnover", "dollar_window"]
    return feed.route_messages(opened).select(
        "kind",
        *[field(n).alias(n) for n in ("ride_id", "timestamp", "dollar_timing")],
        field("ntaxis").cast("bigint").alias("ntaxis"),
        *[field(n).cast("double").alias(n) for n in doubles],
    )


@_register
def ride_trails(rides: DataFrame) -> DataFrame:
    return trails.ride_trails(trails.with_batch(rides)).select("ride_id", "batch_id", "message_id", "weight")


def _held_and_arrived(rides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points before the newest minute of arrivals, and the points of that minute."""
    weight = F.least("passenger_count", F.lit(K.HEAD_WEIGHT)).cast("bigint").alias("weight")
    minutes = rides.select("ride_id", "message_id", S.floor_div(F.col("arrival_ms"), 60_000).alias("minute"), weight)
    newest = minutes.agg(F.max("minute").alias("minute")).scalar()
    return minutes.filter(F.col("minute") < newest), minutes.filter(F.col("minute") == newest)


@_register
def trail_updated(rides: DataFrame) -> DataFrame:
    held, arrived = _held_and_arrived(rides)
    return trails.updated_points(held, arrived)


@_register
def trail_other(rides: DataFrame) -> DataFrame:
    held, arrived = _held_and_arrived(rides)
    return trails.other_points(held, arrived)


@_register
def trail_merge(rides: DataFrame) -> DataFrame:
    held, arrived = _held_and_arrived(rides)
    return trails.merge_batch(held, arrived)


@_register
def heat_weights(rides: DataFrame) -> DataFrame:
    cells = jobs.count_cells(rides).withColumn("arrival_ms", S.floor_div(F.col("window_end_us"), 1000))
    return trails.heat_weights(trails.with_batch(rides), cells, HEAT_EVERY_MS)


@_register
def heat_weights_bundles(rides: DataFrame) -> DataFrame:
    """The same with cells of a fifth of a degree and ten seconds, heavy enough to cull others."""
    cells = jobs.count_cells(rides, 10 * K.SECOND_US, 0.2).withColumn("arrival_ms", S.floor_div(F.col("window_end_us"), 1000))
    return trails.heat_weights(trails.with_batch(rides), cells, HEAT_EVERY_MS)


@_register
def cell_weights(rides: DataFrame) -> DataFrame:
    """Points per cell over ten minutes as weights, weak cells culled."""
    cells = jobs.count_cells(rides, 600 * K.SECOND_US, 0.02)
    weighted = cells.withColumn("weight", trails.cell_weight(F.col("ntaxis")))
    kept = trails.cull_weak(elementwise.positive_weight(weighted), 2)
    return kept.select("window_start_us", "latitude", "longitude", "ntaxis", "weight")


@_register
def flag_duplicates(rides: DataFrame) -> DataFrame:
    return duplicates.duplicate_counts(datasets.deliveries(rides))


@_register
def duplicates_per_batch(rides: DataFrame) -> DataFrame:
    return duplicates.duplicates_per_batch(datasets.deliveries(rides))


def _health(rides: DataFrame) -> DataFrame:
    batches = feed.feed_batches(datasets.deliveries(rides), batch_ms=5000)
    return feed.feed_health(batches, batch_ms=5000, pull_size=9)


@_register
def feed_health(rides: DataFrame) -> DataFrame:
    return _health(rides)


@_register
def feed_health_now(rides: DataFrame) -> DataFrame:
    newest: Column = rides.agg(F.max("arrival_ms")).scalar()
    return feed.health_now(_health(rides), newest, batch_ms=5000).select("feed_id", "batch_id", "data_rate", "status")


@_register
def ring_statistics(rides: DataFrame) -> DataFrame:
    """Batch sizes over the last 15 pull batches of each kind of point."""
    batches = trails.with_batch(rides).groupBy("ride_status", "batch_id").agg(F.count("*").alias("n_messages"))
    chunked = batches.withColumn("_chunk", F.shiftright("batch_id", 14))
    indexed = running_count(chunked, ["ride_status"], ["_chunk", "batch_id"], "batch_index").drop("_chunk")
    return ring_stats(indexed, ["ride_status"], "batch_index", "n_messages", K.HEALTH_BATCHES)


@_register
def bundle_average(rides: DataFrame) -> DataFrame:
    columns = ["window_start_us", "latitude", "longitude", "ntaxis", "cell_index", "avg_ntaxis"]
    return feed.bundle_average(jobs.count_cells(rides)).select(*columns)


@_register
def bundle_average_short(rides: DataFrame) -> DataFrame:
    """The same with a frame of 100 cells, so that it slides at every scale."""
    columns = ["window_start_us", "latitude", "longitude", "ntaxis", "cell_index", "avg_ntaxis"]
    return feed.bundle_average(jobs.count_cells(rides), 100).select(*columns)


@_register
def turnover_board(rides: DataFrame) -> DataFrame:
    board = feed.turnover_board(jobs.turnover_panes(rides))
    return board.select("dollar_window", "dollar_timing", "dollar_turnover", "state", "note", "text")


@_register
def latest_run_rate(rides: DataFrame) -> DataFrame:
    return feed.latest_run_rate(jobs.run_rate(rides))


@_register
def data_clock(rides: DataFrame) -> DataFrame:
    return feed.data_clock(trails.with_batch(elementwise.ride_points(rides)))


@_register
def point_marks(rides: DataFrame) -> DataFrame:
    return feed.point_marks(rides).select("message_id", "ride_id", "point_idx", "offset", "after_done")


@_register
def ride_completeness(rides: DataFrame) -> DataFrame:
    return feed.ride_completeness(rides)


# --- streams -----------------------------------------------------------------------

@_register_stream
def stream_filter_box(stream: DataFrame) -> DataFrame:
    return _plain(jobs.filter_box(stream))


@_register_stream
def stream_max_timestamp(stream: DataFrame) -> DataFrame:
    return jobs.max_timestamp(stream_jobs.watermarked(stream))


@_register_stream
def stream_count_cells(stream: DataFrame) -> DataFrame:
    return jobs.count_cells(stream_jobs.watermarked(stream))


@_register_stream
def stream_run_rate(stream: DataFrame) -> DataFrame:
    return jobs.run_rate(stream_jobs.watermarked(stream))


@_register_stream
def stream_turnover(stream: DataFrame) -> DataFrame:
    return jobs.window_turnover(stream_jobs.watermarked(stream))


@_register_stream
def stream_latest_points(stream: DataFrame) -> DataFrame:
    return _widen(stream_jobs.latest_points(stream_jobs.watermarked(stream, DELAY), K.MINUTE_US).select(*POINT))


@_register_stream
def stream_pickup_points(stream: DataFrame) -> DataFrame:
    return _widen(stream_jobs.pickup_points(stream_jobs.watermarked(stream, DELAY)).select(*POINT))


def stream_drop_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that pass, in the order of their arrival."""
    delivered = datasets.deliveries(R.load_rides(prepare(spark), sf_dir))
    stream = stream_jobs.arrival_ordered(delivered, f"deliveries {sf_dir}")
    return stream_jobs.replay(stream_jobs.drop_resent(stream), "stream_drop_resent", "update").drop("emit_batch")


QUERIES["stream_drop_resent"] = stream_drop_resent


def stream_data_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest payload time; the upsert of the rows that complete mode writes, one per micro-batch."""
    clock = stream_jobs.data_clock(_arriving(spark, sf_dir)).withColumn("clock", F.lit("data"))
    log = stream_jobs.replay(clock, "stream_data_clock", "complete")
    return sinks.log_state(log, ["clock"]).select("clock_ms")


QUERIES["stream_data_clock"] = stream_data_clock


def _pane_query(name: str, build: Callable[[DataFrame], DataFrame], columns: list[str]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = stream_jobs.replay(build(_arriving(spark, sf_dir)), name, "update").select(*columns)
        return _widen(out) if "latitude" in columns else out

    QUERIES[name] = run


_pane_query(
    "stream_turnover_panes",
    stream_panes.turnover_panes,
    ["window_start_us", "dollar_timing", "dollar_turnover", "dollar_window"],
)
_pane_query("stream_latest_panes", lambda s: stream_panes.latest_panes(s, delay_us=DELAY_US), [*POINT, "pane_timing"])
_pane_query("stream_pickup_panes", lambda s: stream_panes.pickup_panes(s, delay_us=DELAY_US), [*POINT, "pane_timing"])


# --- keyed tables, several sinks, dropped rows, live views ---------------------------

def _replayed(name: str, build: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame]) -> None:
    """Register a view of the ride stream whose log of changes ``finish`` reads."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(stream_jobs.replay(build(_arriving(spark, sf_dir)), name, "update"))

    QUERIES[name] = run


def stream_turnover_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turnover board as a keyed table that every micro-batch of panes upserts."""
    panes = stream_panes.turnover_panes(_arriving(spark, sf_dir))
    ranks = F.when(F.col("dollar_timing") == K.LATE, 2).when(F.col("dollar_timing") == K.ON_TIME, 1).otherwise(0)
    table = stream_jobs.replay_upsert(panes.withColumn("pane_rank", ranks), "stream_turnover_board", ["window_start_us"], ["pane_rank"])
    board = table.read().withColumns(feed.display_state(F.col("dollar_timing")))
    return board.select("dollar_window", "dollar_timing", "dollar_turnover", "state", "note")


QUERIES["stream_turnover_board"] = stream_turnover_board


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sinks a message went to: good ones, rejects, and every kind, from one read of the stream."""
    raw = datasets.raw_messages(_arriving(spark, sf_dir))
    judged = R.with_verdict(R.decode_json(raw))
    out = stream_jobs.replay_fan_out(judged, "stream_fan_out", message_parts(["message_id"]))
    reads = [out.read(n, "message_id bigint, reject_reason string").withColumn("sink", F.lit(n)) for n in out.parts]
    both = reads[0]
    for more in reads[1:]:
        both = both.unionByName(more)
    return both.select("sink", "message_id", F.coalesce("reject_reason", F.lit("")).alias("reason"))


QUERIES["stream_fan_out"] = stream_fan_out

_replayed(
    "stream_lateness_rows",
    late.label_rows,
    lambda log: log.select("message_id", "window_start_us", "watermark_us", "lateness"),
)
_replayed("stream_lateness_classes", late.label_windows, late.class_totals)
_replayed(
    "stream_combine_latest",
    lambda s: combined.combine_sessions(elementwise.ride_points(s), K.MINUTE_US, combine.latest_point(), delay_us=DELAY_US),
    _shown,
)
_replayed(
    "stream_ride_gaps",
    views.ride_gaps,
    views.open_gaps,
)
_replayed(
    "stream_ride_trails",
    lambda s: views.ride_trails(trails.with_batch(s)),
    lambda log: sinks.log_state(log, ["message_id"]).filter("weight > 0").select("ride_id", "batch_id", "message_id", "weight"),
)


def stream_feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of each feed after every pull batch, and the instants at which it fell silent."""
    batches = feed.feed_batches(datasets.deliveries(R.load_rides(prepare(spark), sf_dir)), batch_ms=5000)
    at = F.col("batch_id") * 5000
    pulls = batches.select("feed_id", at.alias("at_ms"), "n_messages", "n_duplicates", at.alias("arrival_ms"))
    stream = stream_jobs.arrival_ordered(pulls, f"pulls {sf_dir}")
    live = stream.withColumn("at_ms", F.coalesce("at_ms", "arrival_ms")).fillna(0, ["n_messages", "n_duplicates"])
    return stream_jobs.replay(views.feed_health(live, pull_size=9), "stream_feed_health", "update").drop("emit_batch")


QUERIES["stream_feed_health"] = stream_feed_health


def stream_ring_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch sizes over the last 15 pull batches of each kind of point, as they come."""
    points = trails.with_batch(R.load_rides(prepare(spark), sf_dir))
    sizes = points.groupBy(F.col("ride_status").alias("feed_id"), "batch_id").agg(F.count("*").alias("n_messages"))
    stream = stream_jobs.arrival_ordered(sizes.withColumn("arrival_ms", F.col("batch_id") * K.TICK_MS), f"sizes {sf_dir}")
    out = views.ring(_sized(stream), "feed_id", ["batch_id"], "n_messages", K.HEALTH_BATCHES, "batch_index")
    return stream_jobs.replay(out, "stream_ring_statistics", "update").drop("emit_batch").withColumnRenamed("feed_id", "ride_status")


QUERIES["stream_ring_statistics"] = stream_ring_statistics


def _sized(stream: DataFrame) -> DataFrame:
    return stream.filter(~F.col("feed_id").eqNullSafe(F.lit(stream_jobs.END)))


def _stream_bundles(name: str, n: int) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cells = jobs.count_cells(R.load_rides(prepare(spark), sf_dir)).withColumns(
            {"feed_id": F.lit("cells"), "arrival_ms": S.floor_div(F.col("window_end_us"), 1000)}
        )
        stream = stream_jobs.arrival_ordered(cells, f"cells {sf_dir}")
        order = ["window_start_us", "latitude", "longitude"]
        log = stream_jobs.replay(views.ring(_sized(stream), "feed_id", order, "ntaxis", n, "cell_index"), name, "update")
        return log.select(*order, "ntaxis", "cell_index", F.col("ring_avg").alias("avg_ntaxis"))

    QUERIES[name] = run


_stream_bundles("stream_bundle_average", K.BUNDLE_ROWS)
_stream_bundles("stream_bundle_average_short", 100)


def _union_query(name: str, idle: str | None) -> None:
    """Points per cell and window from two sources with clocks of their own."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = _arriving(spark, sf_dir)
        marks, end = F.col("ride_status") != K.STATUS_ENROUTE, F.col("ride_id") == stream_jobs.END
        sources = [(stream.filter(~marks), "0 seconds"), (stream.filter(marks | end), "90 seconds")]
        cells = jobs.count_cells(union.union_sources(sources, idle=idle))
        return stream_jobs.replay(cells, name).drop("emit_batch")

    QUERIES[name] = run


_union_query("stream_union_cells", None)
_union_query("stream_union_idle", "30 seconds")
_replayed(
    "stream_ride_fading",
    lambda s: views.ride_fading(trails.with_batch(s)),
    lambda log: log.select("ride_id", "batch_ms", "at_ms", "weight"),
)


def stream_heat_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight up to which points are culled at each tick, from cells of a fifth of a degree and ten seconds."""
    cells = jobs.count_cells(R.load_rides(prepare(spark), sf_dir), 10 * K.SECOND_US, 0.2)
    arrived = cells.select("ntaxis", S.floor_div(F.col("window_end_us"), 1000).alias("arrival_ms"), F.lit("cells").alias("feed_id"))
    stream = stream_jobs.arrival_ordered(arrived, f"heavy cells {sf_dir}")
    # the far row that ends the replay weighs enough to move the clock
    heavy = stream.withColumn("ntaxis", F.coalesce("ntaxis", F.lit(1_000)))
    log = stream_jobs.replay(views.cull_limits(heavy), "stream_heat_limits", "update")
    return log.filter(F.col("as_of_ms") < 4_000_000_000 * 1000).select("as_of_ms", "limit")


QUERIES["stream_heat_limits"] = stream_heat_limits
