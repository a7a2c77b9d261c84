"""A keyed table that micro-batches upsert, each exactly once.

Rows are dealt to buckets by a hash of their key. An upsert rewrites the buckets that hold its keys, into a new folder, and
then publishes a manifest that names the folder of every bucket and, per stream, the last batch that it holds. Until
then readers see the version before, afterwards the new one; a micro-batch that comes again changes nothing, and
what a failed attempt left behind is in no manifest. The last ``keep`` versions stay readable, older folders go.

One writer at a time; a second one fails at the manifest that the first has published. The row of a key that was written by a later
batch wins; of several in one batch the one with the greatest ``order``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.sources.files import Store

#: The column that tells which version wrote a row.
VERSION = "_version"


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` bounds what one upsert of few keys rewrites (a share of the table), ``slices`` the files of a bucket."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = 64
    slices: int = 1
    keep: int = 8

    def _store(self) -> Store:
        return Store(self.spark, self.path)

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._store().names(f"{self.path}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default of the newest; the empty table's if there is none."""
        known = self.versions()
        if not known and version is None:
            return {"version": 0, "batches": {}, "folders": {}}
        return json.loads(self._store().read(self._named(known[-1] if version is None else version)))

    def _named(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def _fields(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])

    def _stored(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.path}/data/{f}" for f in folders]
        return self.spark.read.schema(self._fields()).parquet(*paths) if paths else self.spark.createDataFrame([], self._fields())

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the newest."""
        return self._stored(sorted(self.manifest(version)["folders"].values())).drop(VERSION)

    def changes(self, after: int) -> DataFrame:
        """The rows of now that were written after a version; buckets that did not change are not read."""
        now = self.manifest()["folders"]
        newer = [f for f in now.values() if int(f.split("-")[0]) > after]
        return self._stored(sorted(newer)).filter(F.col(VERSION) > after).drop(VERSION)

    def upsert(self, batch: DataFrame, batch_id: int, stream: str = "main") -> bool:
        """Write a micro-batch of ``stream``; False if the table holds it already."""
        old = self.manifest()
        if old["batches"].get(stream, -1) >= batch_id:
            return False
        version = old["version"] + 1
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        newest = F.max_by(F.struct(*rest), F.struct(*self.order)).alias("_v")
        fresh = rows.groupBy(*self.keys).agg(newest).withColumns({VERSION: F.lit(version).cast("long"), "_bucket": bucket})
        fresh = fresh.persist()  # a lost executor means that its part is worked out again
        try:
            touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())  # at most as many as buckets
            folder = f"{version}-{uuid.uuid4().hex}"
            if touched:
                before = [old["folders"][str(b)] for b in touched if str(b) in old["folders"]]
                held = self._stored(before).select(*self.keys, F.struct(*rest).alias("_v"), VERSION, bucket.alias("_bucket"))
                both = held.unionByName(fresh).groupBy("_bucket", *self.keys)
                merged = both.agg(F.max_by("_v", VERSION).alias("_v"), F.max(VERSION).alias(VERSION))
                part = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(self.slices))
                dealt = merged.repartition(len(touched) * self.slices, "_bucket", part)
                out = dealt.select(*[F.col(f.name) if f.name in self.keys else F.col(f"_v.{f.name}").alias(f.name) for f in self.schema.fields], VERSION, "_bucket")
                out.write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        finally:
            fresh.unpersist()
        folders = old["folders"] | {str(b): f"{folder}/_bucket={b}" for b in touched}
        new = {"version": version, "batches": old["batches"] | {stream: batch_id}, "folders": folders}
        self._store().publish(self._named(version), json.dumps(new))
        self._vacuum()
        return True

    def writer(self, stream: str = "main") -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""
        return lambda batch, batch_id: (self.upsert(batch, batch_id, stream), None)[1]

    def _vacuum(self) -> None:
        """Drop the manifests before the last ``keep`` and the folders that none of the others names."""
        store, known = self._store(), self.versions()
        for version in known[: -self.keep]:
            store.remove(self._named(version))
        used = {f.split("/")[0] for v in known[-self.keep :] for f in self.manifest(v)["folders"].values()}
        for name in store.names(f"{self.path}/data"):
            if name not in used:
                store.remove(f"{self.path}/data/{name}")
