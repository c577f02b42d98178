"""Token ids in Arrow files: fixed-size lists of ids and masks, read by position without copying.

Documents are encoded in order of doc_id, each closed by an end id, and cut into sequences of equal
length. Each task writes one Arrow file of sequences (only its last one is padded, with mask 0) and
one of document places. The manifest names the files that count, so a task that runs twice does no
harm. Files of a memory-mapped file system are read without copying; others by range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import fresh_path, saved
from tagloom.llm.vocabulary import words_of

LENGTH = 2048
#: Sequences of one record batch, and documents of one batch of places.
PER_BATCH, PLACES = 64, 4096
MANIFEST = "part int, file string, n_docs long, n_tokens long"


def _located(uri: str):
    """(file system, path) of a folder in any store that pyarrow reads."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class SequenceFile:
    """One file of sequences: any sequence by its number."""

    def __init__(self, uri: str) -> None:
        store, path = _located(uri)
        source = pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``i``; the ids are a view of the file."""
        batch = self.reader.get_batch(i // PER_BATCH)
        lo = (i % PER_BATCH) * self.length
        return (
            batch.column("ids").values.slice(lo, self.length).to_numpy(zero_copy_only=True),
            batch.column("mask").values.slice(lo, self.length),
        )

    def ids(self) -> Iterator[np.ndarray]:
        """All ids in order, a batch at a time, padding included."""
        for b in range(self.reader.num_record_batches):
            yield self.reader.get_batch(b).column("ids").values.to_numpy(zero_copy_only=True)


class _Writer:
    def __init__(self, uri: str, length: int, kind: np.dtype) -> None:
        store, folder = _located(uri.rpartition("/")[0])
        name = uri.rpartition("/")[2]
        store.create_dir(folder, recursive=True)
        self.length, self.kind = length, kind
        self.outs = [store.open_output_stream(f"{folder}/{name}{tail}") for tail in ("", ".places")]
        ids = pa.list_(pa.from_numpy_dtype(kind), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.places = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.files = [pa.ipc.new_file(self.outs[0], self.schema), pa.ipc.new_file(self.outs[1], self.places)]
        self.waiting: list[bytes] = []
        self.size = self.total = self.docs = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, packed: bytes) -> None:
        n = len(packed) // self.kind.itemsize
        self.rows.append((doc_id, self.total, n))
        self.total += n
        self.docs += 1
        self.waiting.append(packed)
        self.size += n
        if self.size >= self.length * PER_BATCH:
            self._flush(False)
        if len(self.rows) >= PLACES:
            self._place()

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), dtype=self.kind)
        step, done = self.length * PER_BATCH, 0
        while len(flat) - done >= step:
            self._batch(flat[done : done + step], step)
            done += step
        rest = flat[done:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.waiting, self.size = [rest.tobytes()], len(rest)

    def _batch(self, ids: np.ndarray, size: int) -> None:
        padded = np.zeros(size, dtype=self.kind)
        padded[: len(ids)] = ids
        columns = [pa.array(padded), pa.array(np.arange(size) < len(ids))]
        self.files[0].write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns], schema=self.schema))

    def _place(self) -> None:
        if self.rows:
            self.files[1].write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.rows)], schema=self.places))
            self.rows = []

    def close(self) -> None:
        self._flush(True)
        self._place()
        for file, out in zip(self.files, self.outs):
            file.close()
            out.close()


def _written(folder: str, path: str, end_id: int, length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        end = np.array([end_id], dtype=words.kind).tobytes()
        task = TaskContext.get()
        file = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.arrow"
        writer = None
        for batch in batches:
            writer = writer or _Writer(file, length, words.kind)
            for doc_id, text in zip(batch.column("doc_id"), batch.column("data")):
                writer.add(doc_id.as_py(), words.encode(text.as_py() or b"") + end)
        if writer:
            writer.close()
            yield pa.record_batch(
                {"part": pa.array([task.partitionId()], pa.int32()), "file": [file], "n_docs": pa.array([writer.docs]), "n_tokens": pa.array([writer.total])}
            )

    return work


def write_sequences(docs: DataFrame, path: str, folder: str, end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Writes the files below ``folder`` and returns their manifest, one row per file.

    Documents are ordered by doc_id, nulls first, repeated ids by text. Null and empty texts give the
    end id alone. An empty table writes nothing. Further columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("data"))
    return saved(ordered.mapInArrow(_written(folder, path, end_id, length), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            source = SequenceFile(row["file"]).ids()
            store, path = _located(row["file"] + ".places")
            places = pa.ipc.open_file(store.open_input_file(path))
            left = np.empty(0, dtype=np.uint16)
            for b in range(places.num_record_batches):
                docs = places.get_batch(b)
                crcs = []
                for n in docs.column("n_tokens").to_pylist():
                    crc = 0
                    while n:
                        if not len(left):
                            left = next(source)
                        crc = zlib.crc32(left[:n].astype("<u4"), crc)
                        n, left = n - len(left[:n]), left[n:]
                    crcs.append(crc)
                starts = docs.column("start").to_numpy() + row["before"]
                yield pa.record_batch(
                    {"doc_id": docs.column("doc_id"), "start": pa.array(starts), "n_tokens": docs.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())}
                )


def read_sequences(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    spark: SparkSession = manifest.sparkSession
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = manifest.select("part", "file", before.alias("before"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(n).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def sequence_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "sequences")
