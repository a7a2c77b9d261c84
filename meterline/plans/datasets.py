"""Inputs derived by Spark from the given tables, for operators whose input is not a plain ride table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.plans import jobs
from meterline.sources import sinks


def deliveries(rides: DataFrame) -> DataFrame:
    """Rides as delivered by a source that re-sends: a third of the points come three times.

    Points with five or six passengers come again ``100 ms * meter_increment`` and 40 s after the first time.
    """
    again = (F.col("meter_increment") * 100).cast("bigint")
    delays = F.when(
        F.col("passenger_count") >= 5, F.array(F.lit(0).cast("bigint"), again, F.lit(40_000).cast("bigint"))
    ).otherwise(F.array(F.lit(0).cast("bigint")))
    return (
        rides.withColumn("_delay", F.explode(delays))
        .withColumn("arrival_ms", F.col("arrival_ms") + F.col("_delay"))
        .withColumn("feed_id", F.col("ride_status"))
        .drop("_delay")
    )


def raw_messages(rides: DataFrame) -> DataFrame:
    """Ride points as JSON text; drop-off points are damaged in a way that depends on the passengers.

    With six passengers the numbers are odd ones, in turn: an increment that is not finite or too large, a
    position that is not finite or beyond a pole, and one in six that is good after all.
    """
    hurt = F.when(F.col("ride_status") == K.STATUS_DROPOFF, F.col("passenger_count")).otherwise(F.lit(0))
    odd = F.when(hurt == 6, F.call_function("div", F.col("message_id"), F.lit(6)) % 6)
    iso = S.ms_to_iso(F.unix_millis("timestamp"))
    fields = F.struct(
        "ride_id",
        F.when(odd == 0, F.lit("NaN")).when(odd == 1, F.lit("91.5")).when(hurt != 1, F.col("latitude").cast("string")).alias("latitude"),
        F.when(odd == 2, F.lit("-Infinity")).otherwise(F.col("longitude").cast("string")).alias("longitude"),
        F.when(hurt == 2, F.regexp_replace(iso, "Z$", "")).otherwise(iso).alias("timestamp"),
        F.when(hurt == 3, F.lit("n/a")).when(odd == 3, F.lit("NaN")).when(odd == 4, F.lit("1e10")).otherwise(F.col("meter_increment").cast("string")).alias("meter_increment"),
        "ride_status",
        "passenger_count",
    )
    text = F.when(hurt == 4, F.lit("{}")).when(hurt == 5, F.lit("{broken")).otherwise(F.to_json(fields))
    return rides.select("message_id", text.alias("value"))


def topic(rides: DataFrame) -> DataFrame:
    """One topic that holds the messages of five jobs."""
    return sinks.one_topic(
        sinks.ride_message(rides),
        sinks.to_message(jobs.count_cells(rides), "cell"),
        sinks.to_message(jobs.run_rate(rides), "rate"),
        sinks.to_message(jobs.turnover_panes(rides), "pane"),
        sinks.to_message(jobs.max_timestamp(rides), "clock"),
    )
