"""Run a ride job on a message stream.

    spark-submit --py-files meterline.zip meterline/run.py \\
        --job count_cells --source /in --sink /out --checkpoint /state

Every job reads JSON ride messages and writes JSON messages of its kind.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.windows import micros
from meterline.plans import jobs
from meterline.session import prepare
from meterline.sources import rides as R
from meterline.sources import sinks
from meterline.sources.fanout import FanOut
from meterline.streaming import panes


@dataclass(frozen=True)
class StreamJob:
    """A job on decoded rides.

    ``build`` maps (rides, watermark delay in us) to results; ``kind`` names their message, None
    passes the input message on unchanged. A row is rejected only for fields in ``needs``.
    """

    build: Callable[[DataFrame, int], DataFrame]
    kind: str | None
    needs: tuple[str, ...]
    output_mode: str = "append"
    early_delay: str = "1 second"


def _windowed(job: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    return lambda rides, delay_us: job(rides.withWatermark("event_ts", micros(delay_us)))


POSITION = ("latitude", "longitude")
POINT = ("ride_id", *POSITION, "timestamp", "ride_status")
FARE = ("meter_increment",)

JOBS: dict[str, StreamJob] = {
    "all_rides": StreamJob(lambda rides, _d: jobs.all_rides(rides), None, ()),
    "filter_box": StreamJob(lambda rides, _d: jobs.filter_box(rides), None, POSITION),
    "filter_prefix": StreamJob(lambda rides, _d: jobs.filter_prefix(rides), None, ("ride_id",)),
    "max_timestamp": StreamJob(_windowed(jobs.max_timestamp), "clock", ("timestamp",)),
    "count_cells": StreamJob(_windowed(jobs.count_cells), "cell", POSITION),
    "run_rate": StreamJob(_windowed(jobs.run_rate), "rate", FARE),
    "exact_turnover": StreamJob(
        lambda rides, d: panes.turnover_panes(rides, delay_us=d), "pane", FARE, "update", K.TURNOVER_EARLY_DELAY
    ),
    "latest_points": StreamJob(
        lambda rides, d: panes.latest_panes(rides, delay_us=d), "point", POINT, "update", K.LATEST_EARLY_DELAY
    ),
    "pickup_points": StreamJob(
        lambda rides, d: panes.pickup_panes(rides, delay_us=d), "point", POINT, "update", K.PICKUP_EARLY_DELAY
    ),
}


def judge(messages: DataFrame, job: StreamJob) -> DataFrame:
    """Decoded messages with the reason why the job cannot use one, if there is one."""
    judged = R.with_verdict(R.decode_json(messages), job.needs)
    if job.kind is None:
        return judged
    # the windows need an event time: the message attribute, or the payload time without one
    timeless = F.col("ts").isNull() & S.iso_to_ms(F.col("timestamp")).isNull()
    reason = F.coalesce("reject_reason", F.when(timeless, F.lit("no event time")))
    return judged.withColumn("reject_reason", reason)


def typed_rides(judged: DataFrame) -> DataFrame:
    """Good rows with their event time."""
    good = R.good_rows(judged).withColumn("_time", F.coalesce("ts", "timestamp"))
    rides = R.with_event_time(good, "_time").drop("_time", "ts")
    # a stand-in order for equal payload times; it does not depend on when a row arrives
    return rides.withColumn("message_id", F.xxhash64("value").bitwiseAND(F.lit(2**62 - 1)))


def start(spark: SparkSession, name: str, config: sinks.JobConfig) -> list[StreamingQuery]:
    job = JOBS[name]
    trigger = config.trigger or {"processingTime": job.early_delay}
    judged = judge(sinks.read_messages(prepare(spark), config), job)
    if not config.rejects:
        messages = _messages(job, typed_rides(judged), config)
        return [sinks.start_messages(messages, config, trigger, job.output_mode)]
    reject = lambda rows: sinks.as_json(R.rejects(rows).select("reject_reason", "value"))
    places, formats = {"rejects": config.rejects, "messages": config.sink}, {"rejects": "text", "messages": config.sink_format}
    if job.kind is None:
        parts = {"rejects": reject, "messages": lambda rows: _messages(job, typed_rides(rows), config)}
        writers = {"messages": sinks.batch_writer(config)} if config.sink_format == "kafka" else {}
        return [FanOut(spark, f"{config.checkpoint}-parts", parts, writers, places, formats).start(judged, config.checkpoint, trigger)]
    # a windowed job has a state of its own: it follows the good rows that the one reader of the source puts down
    parts = {"rejects": reject, "rides": lambda rows: typed_rides(rows).drop("value")}
    intake = FanOut(spark, f"{config.checkpoint}-parts", parts, {}, places, formats)
    reading = intake.start(judged, f"{config.checkpoint}-intake", trigger)
    if trigger.get("availableNow"):
        reading.awaitTermination()
    rides = intake.follow("rides", typed_rides(judged).drop("value").schema, cleanSource="delete")
    return [reading, sinks.start_messages(_messages(job, rides, config), config, trigger, job.output_mode)]


def _messages(job: StreamJob, rides: DataFrame, config: sinks.JobConfig) -> DataFrame:
    out = job.build(rides, config.watermark_delay_us)
    return out.select("value") if job.kind is None else sinks.as_json(sinks.to_message(out, job.kind))


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--job", required=True, choices=sorted(JOBS))
    parser.add_argument("--source", required=True)
    parser.add_argument("--sink", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--source-format", default="text")
    parser.add_argument("--sink-format", default="text")
    parser.add_argument("--watermark-delay-seconds", type=int, default=0)
    parser.add_argument("--rejects")
    parser.add_argument("--event-time", default="ts", help="message attribute with the event time")
    parser.add_argument("--per-trigger", type=int, help="files or Kafka offsets in a micro-batch at most")
    parser.add_argument("--trigger-seconds", type=float, help="instead of the early delay of the job")
    parser.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--once", action="store_true", help="process what the source holds now, then stop")
    return parser


def configured(args: argparse.Namespace) -> sinks.JobConfig:
    trigger = {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else None
    return sinks.JobConfig(
        source=args.source,
        sink=args.sink,
        checkpoint=args.checkpoint,
        source_format=args.source_format,
        sink_format=args.sink_format,
        watermark_delay_us=args.watermark_delay_seconds * K.SECOND_US,
        rejects=args.rejects,
        trigger={"availableNow": True} if args.once else trigger,
        event_time=args.event_time,
        per_trigger=args.per_trigger,
        source_options=_options(args.source_option),
        sink_options=_options(args.sink_option),
    )


def _options(texts: list[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Until all have ended; the failure of any one ends the others and the run."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def main() -> None:
    args = arguments().parse_args()
    spark = SparkSession.builder.appName(f"meterline-{args.job}").getOrCreate()
    wait(spark, start(spark, args.job, configured(args)))


if __name__ == "__main__":
    main()
