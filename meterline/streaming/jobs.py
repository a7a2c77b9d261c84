"""The jobs on a stream, and replays of a folder through them.

The row-wise and windowed jobs are the batch functions on a DataFrame with a watermark.
Results come out when the watermark passes the window end (append mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators import elementwise as E
from meterline.operators.aggs import newest_first, oldest_first
from meterline.operators.sessions import streaming_sessions
from meterline.session import fresh_dir
from meterline.sources.fanout import FanOut, Part
from meterline.sources.files import Store
from meterline.sources.keyed_table import KeyedTable
from meterline.sources.sinks import read_log, start_pane_log
from meterline.streaming import resent


def watermarked(rides: DataFrame, delay: str = "0 seconds") -> DataFrame:
    return rides.withWatermark("event_ts", delay)


def latest_points(rides: DataFrame, gap_us: int = K.LATEST_GAP_US) -> DataFrame:
    """Final newest point of every closed session."""
    point = F.struct("latitude", "longitude", "ts_ms", "message_id", "ride_status")
    return _spread(streaming_sessions(E.ride_points(rides), gap_us, F.max_by(point, newest_first()).alias("p")))


def pickup_points(rides: DataFrame, gap_us: int = K.PICKUP_GAP_US) -> DataFrame:
    """Final pickup point of every closed session that has one."""
    point = F.struct("latitude", "longitude", "ts_ms", "message_id", "ride_status")
    first = F.min_by(point, F.when(F.col("ride_status") == K.STATUS_PICKUP, oldest_first())).alias("p")
    out = _spread(streaming_sessions(E.ride_points(rides), gap_us, first))
    return out.filter(F.col("ride_status") == K.STATUS_PICKUP)


def _spread(sessions: DataFrame) -> DataFrame:
    out = sessions.select("ride_id", "session_start_us", "session_end_us", "p.*")
    return out.withColumn("timestamp", S.ms_to_iso(F.col("ts_ms")))


def data_clock(rides: DataFrame) -> DataFrame:
    """Greatest payload time so far (complete mode: one row)."""
    shown = rides.where(~F.col("ride_id").eqNullSafe(F.lit(END)))
    return shown.agg(F.max(F.unix_millis("timestamp")).alias("clock_ms"))


#: Micro-batches of a replay, and the name and id of the row that ends it.
BATCHES = 12
#: Rows of a file of a replay, about; a micro-batch is read by as many tasks as it has files.
FILE_ROWS = 25_000
END, END_ID = "end of replay", -1

_REPLAYS: dict[tuple[str, str], tuple[str, int]] = {}


def replay_batch(rides: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``rides`` with ``replay_batch``: equal spans of arrival time, from 0."""
    ends = rides.agg(F.min("arrival_ms").alias("lo"), F.max("arrival_ms").alias("hi"))
    first = ends.select("lo").scalar()
    width = ends.select(F.col("hi") - F.col("lo") + 1).scalar()
    at = F.call_function("div", (F.col("arrival_ms") - first) * batches, width)
    return rides.withColumn("replay_batch", at.cast("int"))


def arrival_ordered(rides: DataFrame, label: str, batches: int = BATCHES) -> DataFrame:
    """A stream that delivers a table in arrival order, one micro-batch after the other, and then its end.

    The rows are written once per label and session, one folder per micro-batch; a folder holds as many files as
    a trigger takes, which follow from the rows of the largest micro-batch. The last file is one row far in the future,
    which closes every window and session; results that it makes itself are dropped by ``replay``.
    """
    spark = rides.sparkSession
    key = (spark.sparkContext.applicationId, label)
    if key not in _REPLAYS:
        base = fresh_dir(spark, "replay")
        numbered = fresh_dir(spark, "numbered")
        replay_batch(rides, batches).write.partitionBy("replay_batch").parquet(numbered)
        held = spark.read.schema(T.StructType([*rides.schema.fields, T.StructField("replay_batch", T.IntegerType())])).parquet(numbered)
        most = held.groupBy("replay_batch").count().agg(F.max("count")).first()[0] or 0
        files = max(1, rides.rdd.getNumPartitions() // batches, -(-most // FILE_ROWS))
        for k in range(batches):  # each reads its own folder; the folders are the order
            rows = held.where(F.col("replay_batch") == k).drop("replay_batch")
            rows.repartition(files).write.parquet(f"{base}/{k:04d}")
            there = sum(name.startswith("part-") for name in Store(spark, base).names(f"{base}/{k:04d}"))
            for _ in range(files - there):  # tasks without rows write no file, and a trigger takes so many of them
                rows.limit(0).coalesce(1).write.mode("append").parquet(f"{base}/{k:04d}")
        far = F.timestamp_seconds(F.lit(4_000_000_000))
        last = {"event_ts": far, "timestamp": far, "event_us": F.unix_micros(far), "arrival_ms": F.unix_millis(far)}
        last |= {"ride_id": F.lit(END), "feed_id": F.lit(END), "message_id": F.lit(END_ID), "ride_status": F.lit(K.STATUS_ENROUTE), "meter_increment": F.lit(0.0)}
        end = spark.range(1).select(*[last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rides.schema])
        end.coalesce(1).write.parquet(f"{base}/{batches:04d}")
        _REPLAYS[key] = base, files
    base, files = _REPLAYS[key]
    reader = spark.readStream.schema(rides.schema).option("maxFilesPerTrigger", str(files))
    return reader.parquet(f"{base}/*")


def drop_resent(deliveries: DataFrame, memory_ms: int = K.DUPLICATE_MEMORY_MS, key: str = "message_id", delay: str = "0 seconds") -> DataFrame:
    """(id, arrival ms) of every delivery that makes its id known, whatever the cut into micro-batches.

    The state of an id is the arrival that made it known; a later one than that plus the memory starts anew. A timer
    clears it once the watermark (``delay`` behind the arrivals) has passed its memory.
    """
    return resent.starts(deliveries, memory_ms, key, delay)


def replay(stream: DataFrame, label: str, output_mode: str = "append") -> DataFrame:
    """Run a stream over what its source holds now and return what it wrote, without the rows of the end."""
    spark = stream.sparkSession
    base = fresh_dir(spark, label)
    query = start_pane_log(stream, f"{base}/out", f"{base}/state", {"availableNow": True}, output_mode)
    query.awaitTermination()
    return _without_end(read_log(spark, f"{base}/out", _with_batch(stream)))


def replay_upsert(stream: DataFrame, label: str, keys: list[str], order: list[str], output_mode: str = "update") -> KeyedTable:
    """Run a stream over what its source holds now into a keyed table, without the rows of the end."""
    spark = stream.sparkSession
    base = fresh_dir(spark, label)
    table = KeyedTable(spark, f"{base}/table", stream.schema, tuple(keys), tuple(order), buckets=16)
    write = lambda batch, batch_id: table.writer()(_without_end(batch), batch_id)
    start = stream.writeStream.outputMode(output_mode).option("checkpointLocation", f"{base}/state").foreachBatch(write)
    start.trigger(availableNow=True).start().awaitTermination()
    return table


def replay_fan_out(stream: DataFrame, label: str, parts: dict[str, Part]) -> FanOut:
    """Run a stream over what its source holds now into several sinks, without the rows of the end."""
    spark = stream.sparkSession
    base = fresh_dir(spark, label)
    out = FanOut(spark, f"{base}/out", {name: lambda rows, p=part: p(_without_end(rows)) for name, part in parts.items()})
    out.start(stream, f"{base}/state", {"availableNow": True}).awaitTermination()
    return out


def _without_end(log: DataFrame) -> DataFrame:
    tests = []
    for name in {"ride_id", "feed_id"} & set(log.columns):
        tests.append(~F.col(name).eqNullSafe(F.lit(END)))
    if "message_id" in log.columns:
        tests.append(~F.col("message_id").eqNullSafe(F.lit(END_ID)))
    if "window_start_us" in log.columns:
        tests.append(F.col("window_start_us") < F.lit(4_000_000_000 * K.SECOND_US - 3600 * K.SECOND_US))
    for test in tests:
        log = log.where(test)
    return log


def _with_batch(stream: DataFrame):
    return T.StructType([*stream.schema.fields, T.StructField("emit_batch", T.LongType())])
