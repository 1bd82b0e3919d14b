"""Stored tables whose writes are visible at once or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How the rows a table holds and those that come make the rows it then holds.
Merge = Callable[[DataFrame, DataFrame], DataFrame]


class VersionConflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class VersionedTable:
    """A table under ``path``, in ``buckets`` by a hash of ``key``, with a manifest for each version.

    A write makes new folders for the buckets that its rows' keys fall in, and then a manifest that names the folders
    of all buckets; readers see the newest manifest's folders alone. A write that fails before that leaves the old version
    as it was, and what it left behind is never read. Manifests are made under another name and renamed, which
    the file system does at once and only if no such version is there, so of two writers one gets a VersionConflict.
    Each manifest lists the batches that it contains: a batch that is applied again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The versions that can be read, oldest first."""
        folder = self._hadoop.Path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def _manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            return {"version": 0, "folders": {}, "batches": [], "schema": None}
        chosen = known[-1] if version is None else version
        if chosen not in known:
            raise ValueError(f"there is no version {chosen}")
        source = self._fs.open(self._hadoop.Path(f"{self.path}/manifests/{chosen:08d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def _commit(self, manifest: dict) -> None:
        target = self._hadoop.Path(f"{self.path}/manifests/{manifest['version']:08d}.json")
        draft = self._hadoop.Path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise VersionConflict(f"version {manifest['version']} has been made by another writer")

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one."""
        manifest = self._manifest(version)
        if manifest["schema"] is None:
            raise ValueError("nothing has been written yet")
        return self._rows(manifest, None)

    def _rows(self, manifest: dict, wanted: list[int] | None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f for b, f in manifest["folders"].items() if wanted is None or int(b) in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def apply(self, new: DataFrame, batch: str, merge: Merge) -> bool:
        """Merges rows into the buckets that their keys fall in; False where the batch is there already.

        Columns are those of the first write; a column that comes later has to be added by hand. Only the buckets that
        the new rows fall in are read and written; an empty batch is noted as applied.
        """
        manifest = self._manifest()
        if batch in manifest["batches"]:
            return False
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        touched = sorted(r[0] for r in new.select(bucket.alias("b")).distinct().collect())  # at most ``buckets``
        schema = new.schema if manifest["schema"] is None else T.StructType.fromJson(manifest["schema"])
        folders = dict(manifest["folders"])
        if touched:
            old = self._rows(manifest, touched) if manifest["schema"] is not None else self.spark.createDataFrame([], schema)
            folder = f"data/{uuid.uuid4().hex}"
            merged = merge(old, new).select(*schema.names).withColumn("bucket", bucket)
            # a bucket goes to some tasks, each of which writes one file
            merged.repartition("bucket", F.pmod(F.xxhash64(*schema.names), F.lit(4))).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            for b in touched:
                made = f"{folder}/bucket={b}"
                folders.pop(str(b), None)
                if self._fs.exists(self._hadoop.Path(f"{self.path}/{made}")):  # a merge may leave a bucket without rows
                    folders[str(b)] = made
        self._commit({"version": manifest["version"] + 1, "folders": folders, "batches": [*manifest["batches"], batch], "schema": schema.jsonValue()})
        return True

    def forget(self, keep: int = 1) -> None:
        """Deletes all but the ``keep`` newest versions, and the folders that none of these names."""
        known = self.versions()
        kept = known[-max(1, keep) :]
        named = {f.split("/")[1] for v in kept for f in self._manifest(v)["folders"].values()}
        for v in known[: -max(1, keep)]:
            self._fs.delete(self._hadoop.Path(f"{self.path}/manifests/{v:08d}.json"), False)
        data = self._hadoop.Path(f"{self.path}/data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f.getPath().getName() not in named:
                self._fs.delete(f.getPath(), True)
