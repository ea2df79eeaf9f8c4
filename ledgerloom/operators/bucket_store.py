"""A table in hash buckets of its key, merged batch by batch: only the buckets that a batch touches are written again.

A version of the table is a manifest: the folder that holds each bucket, and the batches that it contains. A merge writes the
touched buckets to a new folder and then puts the next manifest in place with one rename, so readers see whole
versions, a crash before the rename leaves the table as it was, and a batch that is offered again changes nothing. One
writer at a time. Folders of old versions stay for their readers until ``forget_old`` is called.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import upsert as merge

MANIFEST = "bucket int, folder string, batch string"


@dataclass(frozen=True)
class Load:
    """What a merge did. ``applied`` is false for a batch that the table already had; then all counts are zero."""

    applied: bool
    keys: int = 0
    created: int = 0
    updated: int = 0
    buckets: int = 0


class BucketStore:
    """The table below ``folder``; ``schema`` is its columns as DDL, ``keys`` among them."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), keys, buckets
        self.empty = spark.createDataFrame([], schema)

    # --- versions ----------------------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 is the empty table."""
        path, files = self._path("manifest")
        if not files.exists(path):
            return 0
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return max([int(n[1:]) for n in names if n.startswith("v")], default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/v{version}") if version else self.spark.createDataFrame([], MANIFEST)

    def places(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows; there are at most as many as buckets."""
        return {r.bucket: r.folder for r in self.manifest(version).where("bucket IS NOT NULL").collect()}

    def has(self, batch: str) -> bool:
        return not self.manifest().where(F.col("batch") == batch).isEmpty()

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the newest."""
        return self._read(list(self.places(version).values()))

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.empty.schema).parquet(*folders) if folders else self.empty

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # --- merging -----------------------------------------------------------------------------------

    def fold(self, batch: DataFrame, order_by: list[str], policy: str, create_only: tuple[str, ...]) -> DataFrame:
        """One record per key: its last or first, and the first for columns that only a new row takes."""
        last = merge.fold_batch(batch.drop(*create_only), self.keys, order_by, policy)
        if not create_only:
            return last
        chosen = [c for c in batch.columns if c in {*self.keys, *order_by, *create_only}]
        kept = [c for c in create_only if c not in order_by]
        first = merge.fold_batch(batch.select(*chosen), self.keys, order_by, merge.FIRST)
        return last.join(first.select(*self.keys, *kept), self.keys)

    def merge(
        self, batch: DataFrame, name: str, order_by: list[str], policy: str = merge.LAST, create_only: tuple[str, ...] = ()
    ) -> Load:
        """Merges a batch under a name that tells it from all others. Records without a key drop out."""
        if self.has(name):
            return Load(False)
        version, known = self.version(), self.places()
        stage = f"{self.folder}/stage/{uuid.uuid4().hex}"
        self.fold(batch, order_by, policy, create_only).withColumn("_bucket", self.bucket()).write.parquet(stage)
        folded = self.spark.read.parquet(stage)
        touched = sorted(r["_bucket"] for r in folded.select("_bucket").distinct().collect())
        old = self._read([known[b] for b in touched if b in known])
        merged = merge.merge_folded(old, folded.drop("_bucket"), self.keys, policy, create_only)
        target = f"{self.folder}/data/{uuid.uuid4().hex}"
        rows = merged.select(*self.empty.columns).withColumn("_bucket", self.bucket())
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(target)
        now = {**known, **{b: f"{target}/_bucket={b}" for b in touched}}
        self._commit(version + 1, now, name)
        keys, created = folded.count(), self._read([now[b] for b in touched]).count() - old.count()
        self._remove(stage)
        return Load(True, keys, created, keys - created, len(touched))

    def _commit(self, version: int, places: dict[int, str], batch: str) -> None:
        mine = self.spark.createDataFrame([(b, f, None) for b, f in places.items()] + [(None, None, batch)], MANIFEST)
        before = self.manifest(version - 1).where("bucket IS NULL")
        draft = f"drafts/{uuid.uuid4().hex}"
        mine.unionByName(before).write.parquet(f"{self.folder}/{draft}")
        source, files = self._path(draft)
        target, _ = self._path(f"manifest/v{version}")
        files.mkdirs(target.getParent())
        if files.exists(target) or not files.rename(source, target):
            raise RuntimeError(f"another writer made version {version}")

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def forget_old(self) -> None:
        """Removes manifests but the newest, and bucket folders that it does not name."""
        version, kept = self.version(), set(self.places().values())
        for old in range(1, version):
            for folder in set(self.places(old).values()) - kept if self._path(f"manifest/v{old}")[1].exists(self._path(f"manifest/v{old}")[0]) else ():
                self._remove(folder)
            self._remove(f"{self.folder}/manifest/v{old}")
