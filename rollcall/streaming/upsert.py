"""Incremental upsert of a stream into a state table, batch by batch."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.dedupe import keep_best
from rollcall.session import checkpoint_dir

#: Parts of a state; a batch rewrites those its keys fall in.
BUCKETS = 64


def stream_upsert(stream: DataFrame, keys: list[str], order: list[Column], folder: str, buckets: int = BUCKETS, **trigger) -> DataFrame:
    """The state after all data there is: of each key the best row by order.

    The state lies in buckets of keys. A micro-batch writes the buckets it touches, from
    their newest ones, under its own id, and then a manifest of all buckets; the manifest
    commits it, so a batch that runs again writes the same. Files that neither of the last
    two manifests names are deleted. A run without new data returns the committed state; a
    folder without state gives no rows. The order of batches does not matter, as order
    decides. trigger goes to the writer (default availableNow=True).
    """
    spark, schema = stream.sparkSession, stream.schema
    part = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = _Store(spark, folder)
        at = {b: v for b, v in store.manifest(before=batch_id).items()}
        fresh = keep_best(batch, keys, order).withColumn("__bucket", part)
        touched = [r[0] for r in fresh.select("__bucket").distinct().collect()]  # at most as many as buckets
        old = store.read(schema, {b: at[b] for b in touched if b in at})
        rows = keep_best(fresh.drop("__bucket").unionByName(old), keys, order).withColumn("__bucket", part)
        rows.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{folder}/state/v{batch_id}")
        store.commit(batch_id, at | {b: batch_id for b in touched})

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(**(trigger or {"availableNow": True})).start().awaitTermination()
    store = _Store(spark, folder)
    return store.read(schema, store.manifest())


class _Store:
    """Buckets of a state and the manifests that name them, on any file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def _ids(self) -> list[int]:
        found = (re.fullmatch(r"m([0-9]+)\.json", n) for n in self._names(f"{self.folder}/manifests"))
        return sorted(int(m[1]) for m in found if m)

    def _load(self, batch_id: int) -> dict[int, int]:
        row = self.spark.read.text(f"{self.folder}/manifests/m{batch_id}.json", wholetext=True).first()
        return {int(b): v for b, v in json.loads(row[0]).items()}

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> the batch that wrote it, of the newest manifest (older than before)."""
        ids = [i for i in self._ids() if before is None or i < before]
        return self._load(ids[-1]) if ids else {}

    def read(self, schema, at: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/state/v{v}/__bucket={b}" for b, v in sorted(at.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch_id: int, at: dict[int, int]) -> None:
        part, final = (self.path(f"{self.folder}/manifests/{n}m{batch_id}.json") for n in (".", ""))
        out = self.files.create(part, True)
        out.write(bytearray(json.dumps(at).encode()))
        out.close()
        self.files.delete(final, False)
        self.files.rename(part, final)
        kept = self._ids()[-2:]
        named = {(b, v) for i in kept for b, v in self._load(i).items()}
        for i in self._ids():
            if i not in kept:
                self.files.delete(self.path(f"{self.folder}/manifests/m{i}.json"), False)
        for version in self._names(f"{self.folder}/state"):
            v, folder = int(version[1:]), f"{self.folder}/state/{version}"
            held = {int(n.removeprefix("__bucket=")) for n in self._names(folder) if n.startswith("__bucket=")}
            for b in held:
                if (b, v) not in named:
                    self.files.delete(self.path(f"{folder}/__bucket={b}"), True)
            if not any((b, v) in named for b in held):
                self.files.delete(self.path(folder), True)


def state_folder(spark: SparkSession) -> str:
    """A new folder for the state of one stream, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rollcall-stream-{uuid.uuid4().hex}"


def once_within(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Rows of a stream, one for each source id within the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
