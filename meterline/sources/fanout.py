"""One read of a stream, several sinks.

A streaming query has one sink; a second query for the rejects would read and parse the source once more. Here one
``foreachBatch`` holds the micro-batch and gives every sink its part. A part is written to a hidden folder that gets its
name when it is whole, and a marker is published once all parts of the batch are there. So a batch that
comes again after a failure writes what is missing and no more, readers of all sinks see only batches whose marker is
there, and a stream that follows the folders of one sink meets each batch once.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.operators.feed import KINDS
from meterline.sources import rides as R
from meterline.sources.files import Store

Part = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FanOut:
    """``parts`` maps the name of a sink to what it takes of a micro-batch; a part is a folder of ``path``.

    ``places`` puts parts elsewhere and ``formats`` writes them otherwise than as Parquet. A part with one of ``writers``
    is written by it instead, which gets the rows and the number of the batch (all rows, where there is no such part); it must
    take a batch that comes again in its stride, as a keyed table does.
    """

    spark: SparkSession
    path: str
    parts: dict[str, Part]
    writers: dict[str, Callable[[DataFrame, int], None]] = field(default_factory=dict)
    places: dict[str, str] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)

    def place(self, name: str) -> str:
        return self.places.get(name, f"{self.path}/{name}")

    def _marker(self, batch_id: int) -> str:
        return f"{self.path}/_commits/{batch_id:012d}.json"

    def committed(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in Store(self.spark, self.path).names(f"{self.path}/_commits") if n.endswith(".json")]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        store = Store(self.spark, self.path)
        if store.exists(self._marker(batch_id)):
            return
        held = batch.persist()  # read and parsed once; a lost executor means that its part is read again
        try:
            folders = {name: part for name, part in self.parts.items() if name not in self.writers}
            for name, part in folders.items():
                whole, hidden = f"{self.place(name)}/batch={batch_id}", f"{self.place(name)}/.batch={batch_id}"
                if not store.exists(whole):
                    part(held).write.format(self.formats.get(name, "parquet")).mode("overwrite").save(hidden)
                    store.rename(hidden, whole)
            for name, write in self.writers.items():
                write(self.parts[name](held) if name in self.parts else held, batch_id)
        finally:
            held.unpersist()
        store.publish(self._marker(batch_id), json.dumps({"batch": batch_id, "parts": sorted(self.parts)}))

    def read(self, name: str, schema) -> DataFrame:
        """The rows of a part in all batches whose marker is there."""
        paths = [f"{self.place(name)}/batch={b}" for b in self.committed()]
        reader = self.spark.read.schema(schema).format(self.formats.get(name, "parquet"))
        return reader.load(paths) if paths else self.spark.createDataFrame([], schema)

    def follow(self, name: str, schema, **options: str) -> DataFrame:
        """A part as a stream; a batch shows when its folder has its name."""
        reader = self.spark.readStream.schema(schema).format(self.formats.get(name, "parquet")).options(**options)
        return reader.load(f"{self.place(name)}/batch=*")

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
        return writer.foreachBatch(self.write).start()


def message_parts(columns: list[str], value: str = "value") -> dict[str, Part]:
    """Sinks for JSON messages judged by ``rides.with_verdict``: good ones, rejects, and every kind by key presence.

    A message may be of several kinds or none; a reject of one job may still be a message of a kind.
    """

    def kind(key: str) -> Part:
        present = F.map_contains_key(F.from_json(value, "map<string,string>"), key)
        return lambda judged: judged.filter(F.coalesce(present, F.lit(False))).select(*columns, value)

    good = lambda judged: R.good_rows(judged).select(*columns, "latitude", "longitude", "timestamp", "meter_increment")
    bad = lambda judged: R.rejects(judged).select(*columns, "reject_reason", value)
    return {"good": good, "rejects": bad} | {name: kind(key) for name, key in KINDS.items()}
