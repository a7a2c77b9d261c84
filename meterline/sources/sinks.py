"""Job settings, message projections, and writing results out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline import schema
from meterline.functions import scalars as S
from meterline.operators.aggs import upsert_latest

MESSAGE_COLUMNS = {
    "point": schema.POINT_COLUMNS,
    "cell": schema.CELL_COLUMNS,
    "rate": schema.RATE_COLUMNS,
    "pane": schema.PANE_COLUMNS,
    "clock": schema.CLOCK_COLUMNS,
}


@dataclass(frozen=True)
class JobConfig:
    """What a job reads and writes.

    ``source_format`` is ``kafka`` (``source`` is the topic), ``text`` (one JSON message per line, the payload
    time is the event time), or any format with a column ``value`` and one for the event time. ``event_time``
    names the message attribute that holds the event time: a Kafka header, or a column. A Kafka record without it
    has its record time. ``per_trigger`` bounds a micro-batch: files, or Kafka offsets. Options go to the reader and
    writer unchanged. Without a trigger a job takes its own early-result delay. ``rejects`` names a folder
    for undecodable rows.
    """

    source: str
    sink: str
    checkpoint: str
    source_format: str = "text"
    sink_format: str = "text"
    watermark_delay_us: int = 0
    trigger: dict | None = None
    rejects: str | None = None
    event_time: str = "ts"
    per_trigger: int | None = None
    source_options: dict = field(default_factory=dict)
    sink_options: dict = field(default_factory=dict)


def read_messages(spark: SparkSession, config: JobConfig, stream: bool = True) -> DataFrame:
    """``value`` (JSON text) and ``ts`` (event time attribute, NULL where the source has none)."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format(config.source_format).options(**source_options(config))
    if config.source_format == "kafka":
        return kafka_values(reader.load(), config.event_time)
    if config.source_format == "text":
        return reader.load(config.source).select("value", F.lit(None).cast("timestamp").alias("ts"))
    rows = reader.schema(f"value string, `{config.event_time}` timestamp").load(config.source)
    return rows.select("value", F.col(f"`{config.event_time}`").alias("ts"))


def source_options(config: JobConfig) -> dict[str, str]:
    """Options of the reader: the given ones, the topic and headers of Kafka, and the bound of a micro-batch."""
    kafka = config.source_format == "kafka"
    options = {"subscribe": config.source, "includeHeaders": "true"} if kafka else {}
    if config.per_trigger is not None:
        options["maxOffsetsPerTrigger" if kafka else "maxFilesPerTrigger"] = str(config.per_trigger)
    return options | config.source_options


def kafka_values(records: DataFrame, event_time: str) -> DataFrame:
    """Text and event time of Kafka records: the named header (ISO text), else the record time."""
    header = F.filter(F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")), lambda h: h["key"] == event_time)
    named = F.try_to_timestamp(F.get(header, F.lit(0))["value"].cast("string"))
    return records.select(F.col("value").cast("string").alias("value"), F.coalesce(named, F.col("timestamp")).alias("ts"))


def to_message(df: DataFrame, kind: str) -> DataFrame:
    """The columns that go out for a kind of result (windows and keys stay behind)."""
    return df.select(*MESSAGE_COLUMNS[kind])


def ride_message(rides: DataFrame) -> DataFrame:
    return rides.select(
        "ride_id",
        "latitude",
        "longitude",
        S.ms_to_iso(F.unix_millis("timestamp")).alias("timestamp"),
        "meter_increment",
        "ride_status",
        "passenger_count",
    )


def one_topic(*messages: DataFrame) -> DataFrame:
    """All kinds of messages in one table; a message holds only the keys of its kind."""
    out = messages[0]
    for more in messages[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def start_messages(messages: DataFrame, config: JobConfig, trigger: dict, output_mode: str = "append") -> StreamingQuery:
    """Send a ``value`` column to the configured sink.

    File sinks know append mode only, so changed panes go to one folder per micro-batch.
    """
    if output_mode != "append" and config.sink_format != "kafka":

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.format(config.sink_format).mode("overwrite").save(f"{config.sink}/emit_batch={batch_id}")

        writer = messages.writeStream.foreachBatch(write)
    else:
        writer = messages.writeStream.format(config.sink_format).options(**config.sink_options)
        writer = writer.option("topic" if config.sink_format == "kafka" else "path", config.sink)
    return writer.outputMode(output_mode).option("checkpointLocation", config.checkpoint).trigger(**trigger).start()


def batch_writer(config: JobConfig):
    """Sends the ``value`` column of a micro-batch to the topic of a job; a batch that comes again is sent again."""

    def write(messages: DataFrame, batch_id: int) -> None:
        messages.write.format(config.sink_format).options(**config.sink_options).option("topic", config.sink).save()

    return write


def start_pane_log(df: DataFrame, path: str, checkpoint: str, trigger: dict, output_mode: str = "update") -> StreamingQuery:
    """Append every micro-batch of changed rows to a log, one folder per micro-batch.

    A repeated micro-batch overwrites its own folder, so a restart leaves no double rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/emit_batch={batch_id}")

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def read_log(spark: SparkSession, path: str, fields) -> DataFrame:
    return spark.read.schema(fields).parquet(path)


def log_state(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key of a pane log: the upsert, done when it is read."""
    return upsert_latest(log, keys, "emit_batch")
