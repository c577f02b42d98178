"""A stored profile that a job updates without rewriting it.

The profile is cut into hash buckets of its first key, the user or the item. A bucket is a folder of Parquet
files that is written once and never changed. A version of the profile is a manifest: which folder each bucket
is read from, and the columns. An upsert reads, merges and writes only the buckets that hold fresh keys, then
publishes the next manifest by a rename, which either happens or doesn't: readers see the old version or the new
one, a run that dies leaves folders that no manifest names, and of two writers one is refused.

    store = ProfileStore(spark, root, ["user_id"])
    store.upsert(fresh)             # fresh values win, stored ones stay where fresh has NULL or no row
    store.read()                    # the newest version; store.read(3) an older one
    store.rows_of(["17", "23"])     # reads the buckets of these users only
    store.vacuum(keep=2)            # deletes what the last two versions don't use
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tagloom.sinks.profile import merge_profile

#: Buckets of a new profile; a bucket should hold some 100 MB to 1 GB.
BUCKETS = 64
BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer published the version first; run the upsert again."""


@dataclass(frozen=True)
class Manifest:
    """One version: the folder of each bucket that has rows, relative to the profile's root."""

    version: int
    keys: list[str]
    buckets: int
    schema: dict
    folders: dict[str, str]


class Versions:
    """Numbered manifests below a root folder, each published by one rename."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # Files, through Hadoop's interface, so that the driver needs no local path.

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        files, folder = self._files(), self._path(*parts)
        if not files.exists(folder):
            return []
        return sorted(str(s.getPath().getName()) for s in files.listStatus(folder))

    def versions(self) -> list[int]:
        names = self._names("manifests")
        return [int(n.removesuffix(".json")) for n in names if n[0].isdigit()]

    def _content(self, version: int | None = None) -> dict | None:
        """What a version's manifest holds, by default the newest's; None while there is none."""
        known = self.versions()
        if not known and version is None:
            return None
        version = known[-1] if version is None else version
        path = str(self._path("manifests", f"{version:010d}.json"))
        return json.loads(self.spark.read.text(path, wholetext=True).first()["value"])

    def _publish(self, content: dict) -> None:
        files, version = self._files(), content["version"]
        draft = self._path("manifests", f"_draft-{uuid.uuid4().hex}")
        target = self._path("manifests", f"{version:010d}.json")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise Conflict(f"version {version} was published by another writer")


class ProfileStore(Versions):
    """Versions of one profile below ``root``, on any file system that Spark reaches."""

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], buckets: int = BUCKETS
    ) -> None:
        super().__init__(spark, root)
        self.keys = keys
        found = self.manifest()
        if found is not None and found.keys != keys:
            raise ValueError(f"this profile has the keys {found.keys}")
        self.buckets = buckets if found is None else found.buckets

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest, by default the newest; None while there is none."""
        content = self._content(version)
        return None if content is None else Manifest(**content)

    # Rows.

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _rows(self, manifest: Manifest | None, buckets: Iterable[str] | None = None) -> DataFrame:
        """Rows of some buckets of a version, by default of all."""
        schema = StructType([]) if manifest is None else StructType.fromJson(manifest.schema)
        wanted = {} if manifest is None else manifest.folders
        if buckets is not None:
            wanted = {b: wanted[b] for b in buckets if b in wanted}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(
            *[f"{self.root}/{folder}" for folder in wanted.values()]
        )

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"no profile at {self.root}")
        return self._rows(manifest)

    def rows_of(self, firsts: list[str], version: int | None = None) -> DataFrame:
        """Rows of some users (or items), from their buckets alone."""
        values = self.spark.createDataFrame([(str(v),) for v in firsts], "first string")
        buckets = {str(r[0]) for r in values.select(self._bucket(F.col("first"))).collect()}
        rows = self._rows(self.manifest(version), buckets)
        return rows.filter(F.col(self.keys[0]).isin([str(v) for v in firsts]))

    def upsert(self, fresh: DataFrame) -> Manifest:
        """Merge ``fresh``, one row per key, into the buckets of its keys; other buckets keep their files.

        Rows with a NULL key are refused. The fresh rows are written first, so they are worked out
        once; where a bucket had no rows before, these files are the bucket.
        """
        before = self.manifest()
        version = 1 if before is None else before.version + 1
        folders = {} if before is None else dict(before.folders)
        columns = self._columns(before, fresh)
        staged = f"staged/{version:010d}-{uuid.uuid4().hex}"
        self._write(fresh, staged)
        names = self._names(staged)
        touched = [n.removeprefix(f"{BUCKET}=") for n in names if n.startswith(BUCKET)]
        merging = [b for b in touched if b in folders]
        rows = self._staged(fresh, staged)
        if touched and not rows.filter(" or ".join(f"`{k}` is null" for k in self.keys)).isEmpty():
            self._files().delete(self._path(staged), True)
            raise ValueError("fresh rows need all their keys")
        folders.update({b: f"{staged}/{BUCKET}={b}" for b in touched})
        if merging:
            target = f"data/{version:010d}-{uuid.uuid4().hex}"
            changed = rows.filter(F.col(BUCKET).isin([int(b) for b in merging])).drop(BUCKET)
            self._write(merge_profile(self._rows(before, merging), changed, self.keys), target)
            folders.update({b: f"{target}/{BUCKET}={b}" for b in merging})
        manifest = Manifest(version, self.keys, self.buckets, columns.jsonValue(), folders)
        self._publish(asdict(manifest))
        return manifest

    def _columns(self, before: Manifest | None, fresh: DataFrame) -> StructType:
        """The profile's columns and the new ones of ``fresh``; a column never changes its type."""
        known = [] if before is None else StructType.fromJson(before.schema).fields
        types = {f.name: f.dataType for f in known}
        for field in fresh.schema.fields:
            if types.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"{field.name} is {types[field.name].simpleString()} in the profile")
        return StructType([StructField(name, kind) for name, kind in types.items()])

    def _staged(self, fresh: DataFrame, folder: str) -> DataFrame:
        fields = [StructField(f.name, f.dataType) for f in fresh.schema.fields]
        schema = StructType([*fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows brought together by bucket; one with very many is written by several tasks."""
        placed = rows.withColumn(BUCKET, self._bucket(F.col(self.keys[0])))
        writer = placed.hint("rebalance", BUCKET).write.mode("errorifexists")
        writer.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions but the last ``keep``, and all folders these don't use; not beside a writer."""
        kept = self.versions()[-max(1, keep) :]
        used = {f for v in kept for f in self.manifest(v).folders.values()}
        files, gone = self._files(), []
        for top in ("data", "staged"):
            for run in self._names(top):
                for name in [n for n in self._names(top, run) if n.startswith(BUCKET)]:
                    if f"{top}/{run}/{name}" not in used:
                        files.delete(self._path(top, run, name), True)
                        gone.append(f"{top}/{run}/{name}")
                if not any(n.startswith(BUCKET) for n in self._names(top, run)):
                    files.delete(self._path(top, run), True)
        for name in self._names("manifests"):
            if not name[0].isdigit() or int(name.removesuffix(".json")) not in kept:
                files.delete(self._path("manifests", name), False)
        return gone
