"""A keyed table in buckets with a manifest: an upsert rewrites the buckets that it touches and no others.

Below the table's folder stand part folders, written once and never changed, and manifests ``m-<number>``, small JSON
files: which folder holds which bucket, the schema, and the batches that went in. A version is a manifest; the newest one
counts. It is put in place by a rename, so a job that dies before leaves the table as it was, and of two writers of one
version one fails. To roll back is to write the manifest of an earlier version again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Batches that a manifest remembers.
REMEMBERED = 1000


class KeyedTable:
    """A table of one row per key below ``path``, dealt to ``buckets`` by the key's hash."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        where = self._path(self.path)
        if not self._fs.exists(where):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(where)]
        return sorted(int(n[2:]) for n in names if n.startswith("m-"))

    def manifest(self, version: int | None = None) -> dict:
        """What a version consists of; the newest by default."""
        known = self.versions()
        if not known:
            return {"version": 0, "buckets": {}, "batches": [], "schema": None}
        stream = self._fs.open(self._path(f"{self.path}/m-{version or known[-1]:012d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, manifest: dict) -> None:
        target = self._path(f"{self.path}/m-{manifest['version']:012d}")
        draft = self._path(f"{self.path}/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise RuntimeError(f"version {manifest['version']} of {self.path} was written by another job")

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; None if nothing was ever written."""
        m = self.manifest(version)
        if m["schema"] is None:
            return None
        return self._read(m, list(m["buckets"]))

    def _read(self, m: dict, buckets: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        folders = sorted({f"{self.path}/{m['buckets'][b]}/bucket={b}" for b in buckets})
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets))

    def upsert(self, updates: DataFrame, batch: str | None = None, order: str | None = None, insert_only: bool = False, validate=None) -> dict:
        """Replaces or adds a row per key (with ``insert_only``: adds those that are absent) and returns the manifest.

        Of several updates of a key the last by ``order`` counts (the greatest row without it); ``order`` is not stored.
        A ``batch`` that went in before changes nothing, so a replay is harmless. ``validate(rows of the touched buckets)``
        returns bad rows; if there are any nothing is put in place, and the manifest that is returned is the old one.
        """
        old = self.manifest()
        if batch is not None and batch in old["batches"]:
            return old
        kept = [c for c in updates.columns if c != order]
        last = F.max(F.struct(*([F.col(order).alias("_o")] if order else []), *kept)).alias("_u")
        folder = f"part-{uuid.uuid4().hex}"
        fresh = updates.groupBy(self.key).agg(last).select(*[F.col("_u")[c].alias(c) for c in kept]).withColumn("bucket", self._bucket())
        staged = f"{self.path}/.staged-{folder}"
        fresh.write.parquet(staged)
        fresh = self.spark.read.schema(fresh.schema).parquet(staged)
        touched = [str(r[0]) for r in fresh.select("bucket").distinct().collect()]  # as many as there are buckets at most
        schema = T.StructType.fromJson(old["schema"]) if old["schema"] else T.StructType([f for f in fresh.schema.fields if f.name != "bucket"])
        names = [f.name for f in schema.fields]
        new = fresh.select(*names, "bucket")
        here = [b for b in touched if b in old["buckets"]]
        if here:
            have = self._read(old, here).withColumn("bucket", self._bucket())
            if insert_only:
                new = have.unionByName(new.join(have.select(self.key), self.key, "left_anti"))
            else:
                new = have.join(new.select(self.key), self.key, "left_anti").unionByName(new)
        if touched:
            new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        self._fs.delete(self._path(staged), True)
        now = {"version": old["version"] + 1, "schema": json.loads(schema.json()), "buckets": old["buckets"] | {b: folder for b in touched}}
        now["batches"] = [*old["batches"], *([batch] if batch is not None else [])][-REMEMBERED:]
        if validate is not None and touched and not validate(self._read(now, touched)).isEmpty():
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
            return old
        self._commit(now)
        return now

    def roll_back(self, version: int) -> dict:
        """Makes an earlier version the newest; what came after stays readable by its number."""
        m = self.manifest(version) | {"version": self.versions()[-1] + 1}
        self._commit(m)
        return m


def upsert_stream(stream: DataFrame, target: KeyedTable, checkpoint: str, name: str, transform=lambda df: df):
    """Upserts each micro-batch of a stream; a batch that is replayed after a failure changes nothing. The started query."""

    def put(df: DataFrame, batch: int) -> None:
        target.upsert(transform(df), batch=f"{name}-{batch}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
