"""Reading ride points: tables, streams, JSON messages, base64 envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.schema import EVENTS_SCHEMA, RIDE_TEXT_SCHEMA

MALFORMED = "_malformed"
REQUIRED = ("ride_id", "latitude", "longitude", "timestamp", "meter_increment", "ride_status")

# The event table spans 30 days; time is compressed so that 1 s and 1 min windows fill up.
BASE_US = 1_704_067_200_000_000
COMPRESSION = 720


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    # The glob makes a single file and a folder of part files work alike.
    return spark.readStream.schema(EVENTS_SCHEMA).options(**options).parquet(f"{sf_dir}/events.parque[t]")


def rides_from_events(events: DataFrame) -> DataFrame:
    """Ride points derived from the event table (batch or stream). One narrow projection.

    ``event_us`` is the event time, ``timestamp`` the payload time; the two are separate
    clocks even though this source sets them equal.
    """
    event_id = F.col("event_id")
    event_us = F.lit(BASE_US) + F.expr(
        f"(unix_micros(CAST(ts AS TIMESTAMP)) - {BASE_US}) div {COMPRESSION}"
    )
    status = (
        F.when(F.col("event_type") == "signup", K.STATUS_PICKUP)
        .when(F.col("event_type") == "purchase", K.STATUS_DROPOFF)
        .otherwise(K.STATUS_ENROUTE)
    )
    delay_ms = F.when(event_id % 10 == 3, event_id * 7919 % 480000).otherwise(F.lit(0).cast("bigint"))
    return (
        events.withColumn("event_us", event_us)
        .select(
            F.md5(F.col("user_id").cast("string")).alias("ride_id"),
            event_id.alias("message_id"),
            "event_us",
            F.timestamp_micros("event_us").alias("event_ts"),
            F.timestamp_micros("event_us").alias("timestamp"),
            (F.lit(40.60) + (event_id * 7919 % 30000) / F.lit(100000.0)).alias("latitude"),
            (F.lit(-74.10) + (event_id * 104729 % 30000) / F.lit(100000.0)).alias("longitude"),
            (event_id * 31 % 10000 / F.lit(100.0)).alias("meter_reading"),
            F.col("value").alias("meter_increment"),
            status.alias("ride_status"),
            (event_id % 6 + 1).cast("int").alias("passenger_count"),
            event_id.alias("point_idx"),  # message ids: the points of a ride are full of gaps
            (F.expr("event_us div 1000") + delay_ms).alias("arrival_ms"),
        )
    )


def load_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_from_events(read_events(spark, sf_dir))


# --- JSON messages -----------------------------------------------------------

def decode_json(messages: DataFrame, column: str = "value") -> DataFrame:
    """Parse a JSON text column into string fields; the raw text stays for the reject side.

    The parse is a generator, so later filters on the fields cannot be moved below it, where
    they would parse the text again for every field they test.
    """
    schema = T.StructType([*RIDE_TEXT_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())])
    parsed = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": MALFORMED})
    return messages.select(*messages.columns, F.inline(F.array(parsed)))


def reject_reason(required: tuple[str, ...] = REQUIRED) -> Column:
    """First rule a decoded row breaks; NULL for a good row. Fields not required may be absent or odd."""
    checks = {
        "latitude": S.degrees(F.col("latitude"), 90),
        "longitude": S.degrees(F.col("longitude"), 180),
        "timestamp": S.iso_to_ms(F.col("timestamp")),
        "meter_increment": S.amount(F.col("meter_increment")),
    }
    reasons = [F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed"))]
    for name in required:
        reasons.append(F.when(F.col(name).isNull(), F.lit(f"missing {name}")))
        if name in checks:
            reasons.append(F.when(checks[name].isNull(), F.lit(f"bad {name}")))
    return F.coalesce(*reasons)


def with_verdict(decoded: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    return decoded.withColumn("reject_reason", reject_reason(required)).drop(MALFORMED)


def typed_fields() -> dict[str, Column]:
    """Typed values of the text fields; NULL where a text does not parse."""
    return {
        "latitude": S.degrees(F.col("latitude"), 90),
        "longitude": S.degrees(F.col("longitude"), 180),
        "timestamp": F.try_to_timestamp("timestamp"),
        "meter_reading": S.number(F.col("meter_reading")),
        "meter_increment": S.amount(F.col("meter_increment")),
        "passenger_count": F.col("passenger_count").try_cast("int"),
        "point_idx": F.col("point_idx").try_cast("bigint"),
    }


def good_rows(judged: DataFrame) -> DataFrame:
    """Typed ride points of the rows without a reject reason."""
    good = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good.withColumns({k: v for k, v in typed_fields().items() if k in good.columns})


def rejects(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNotNull())


def with_event_time(df: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """Take the event time from a message attribute; the payload time is left alone."""
    timed = df.withColumn("event_ts", F.col(column).cast("timestamp"))
    timed = timed.withColumn("event_us", F.unix_micros("event_ts"))
    return timed.withWatermark("event_ts", delay) if delay is not None else timed


# --- envelopes ---------------------------------------------------------------

def open_envelopes(envelopes: DataFrame, column: str = "data") -> DataFrame:
    """base64 JSON -> ``fields`` map. A key whose value is JSON null is still present."""
    fields = F.from_json(S.from_base64_text(F.col(column)), "map<string,string>")
    return envelopes.select(*envelopes.columns, F.inline(F.array(F.struct(fields.alias("fields")))))


def seal_envelopes(messages: DataFrame, column: str = "data") -> DataFrame:
    """Rows -> base64 JSON; NULL fields are left out, so key presence tells the kind."""
    return messages.select(F.base64(F.to_json(F.struct("*")).cast("binary")).alias(column))
