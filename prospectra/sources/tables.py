"""Tables in buckets by key, of which a change writes only the buckets that it touches.

Rows are dealt to buckets by a hash of their key, and written as Parquet by Spark, a folder a bucket. A version of the
table is one small manifest that lists the folders of each bucket; a change writes new folders for the buckets that
its keys are in, then a manifest, by renaming, so readers see all of a change or nothing, and earlier versions stay
readable. Folders that no manifest names (of a writer that died) are never read.

A change of a stream carries the stream's name and batch id, which the manifest keeps: a batch that comes again is
already there and does nothing. Two writers that start from one version cannot both commit: the second gets an error.

What the driver holds is the manifest: a few folder names a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, file_system

Fold = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class Manifest:
    version: int
    key: list[str]
    n_buckets: int
    schema: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class VersionConflict(RuntimeError):
    """Another writer has made the next version of the table."""


class BucketTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: list[str], n_buckets: int = 64) -> BucketTable:
        """A new table of rows; there must be none at the path."""
        out = cls(rows.sparkSession, path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        out._commit(Manifest(0, list(key), n_buckets, schema, out._written(rows, key, n_buckets)))
        return out

    # Manifests.

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:012}.json"

    def versions(self) -> list[int]:
        store, folder = file_system(self.spark, f"{self.path}/versions")
        found = store.listStatus(folder) if store.exists(folder) else []
        names = [x.getPath().getName() for x in found]
        return sorted(int(n[:12]) for n in names if n.endswith(".json") and n[:12].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        have = self.versions()
        version = max(have, default=-1) if version is None else version
        if version not in have:
            raise ValueError(f"{self.path} has no version {version}")
        return Manifest(**json.loads(self.spark.read.text(self._manifest_path(version)).first()[0]))

    def _commit(self, new: Manifest) -> None:
        store, target = file_system(self.spark, self._manifest_path(new.version))
        _, draft = file_system(self.spark, f"{self.path}/versions/{new.version:012}-{uuid.uuid4().hex}.draft")
        if store.exists(target):
            raise VersionConflict(f"{self.path} has a version {new.version} already")
        out = store.create(draft, False)
        out.write(bytearray(json.dumps(vars(new)).encode()))
        out.close()
        if not store.rename(draft, target):
            store.delete(draft, False)
            raise VersionConflict(f"{self.path} has a version {new.version} already")

    # Rows.

    @staticmethod
    def _bucket(key: list[str], n: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(n)).cast("int")

    def _written(self, rows: DataFrame, key: list[str], n: int) -> dict[str, list[str]]:
        """Writes rows by bucket to a new folder: the folder of each bucket that has rows."""
        folder = f"data/{uuid.uuid4().hex[:12]}"
        bucket = self._bucket(key, n)
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        store, where = file_system(self.spark, f"{self.path}/{folder}")
        names = [x.getPath().getName() for x in store.listStatus(where)]
        return {n.removeprefix("_bucket="): [f"{folder}/{n}"] for n in names if n.startswith("_bucket=")}

    def _read(self, m: Manifest, buckets: list[str] | None = None) -> DataFrame:
        folders = [f for b, found in m.folders.items() if buckets is None or b in buckets for f in found]
        if not folders:
            return self.spark.createDataFrame([], m.schema)
        return self.spark.read.schema(m.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    def _seen(self, m: Manifest, batch: tuple[str, int] | None) -> bool:
        return batch is not None and m.batches.get(batch[0], -1) >= batch[1]

    def change(self, changes: DataFrame, fold: Fold, batch: tuple[str, int] | None = None) -> bool:
        """New rows of the buckets that keys of changes are in: fold(their rows, changes). False if the batch was there already.

        The fold must look at nothing but rows of equal key, as the operators of `crud` do.
        """
        m = self.manifest()
        if self._seen(m, batch):
            return False
        bucket = self._bucket(m.key, m.n_buckets)
        changes = cut(changes, "changes")
        touched = [str(r[0]) for r in changes.select(bucket.alias("b")).distinct().collect()]  # at most n_buckets
        fresh = self._written(fold(self._read(m, touched), changes).select(*self._read(m, []).columns), m.key, m.n_buckets) if touched else {}
        folders = {b: f for b, f in m.folders.items() if b not in touched} | fresh
        self._commit(Manifest(m.version + 1, m.key, m.n_buckets, m.schema, folders, m.batches | dict([batch] if batch else [])))
        return True

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """More rows, beside those there: nothing is read or written again. False if the batch was there already."""
        m = self.manifest()
        if self._seen(m, batch):
            return False
        fresh = self._written(rows.select(*self._read(m, []).columns), m.key, m.n_buckets)
        folders = m.folders | {b: m.folders.get(b, []) + f for b, f in fresh.items()}
        self._commit(Manifest(m.version + 1, m.key, m.n_buckets, m.schema, folders, m.batches | dict([batch] if batch else [])))
        return True


def appending(table: BucketTable, stream: str) -> Callable[[DataFrame, int], None]:
    """For `writeStream.foreachBatch`: each batch is appended once, however often it is run."""
    return lambda rows, batch: table.append(rows, (stream, batch)) and None


def folding(table: BucketTable, stream: str, fold: Fold) -> Callable[[DataFrame, int], None]:
    """For `writeStream.foreachBatch`: each batch is folded into the table once, however often it is run."""
    return lambda rows, batch: table.change(rows, fold, (stream, batch)) and None
