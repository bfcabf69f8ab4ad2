"""Token ids in Arrow IPC files of equal-length sequences.

A data set is a folder with, for each shard, ``N.arrow`` (record batches with the columns
``ids``: fixed-size list of uint16 or uint32, ``mask``: fixed-size list of bool, true for
ids and false for padding) and ``N.docs.arrow`` (doc_id, start in the shard, n_tokens).
The buffers are not compressed, so that any sequence is read from a memory map without a
copy. Shards are consecutive ranges of ascending doc_id; shard ``k`` has the ids after
those of shard ``k - 1``, and only its last sequence has padding.

Tasks write under a name of their own and rename at the end, so that a task that runs
twice leaves one whole file. The manifest (one row a shard) is all the driver sees.

Defined results: null text counts as empty, an empty document has only its end id, a null
doc_id comes first, documents with the same doc_id follow in the order of a hash of their
text, then of the text.
Other columns of the input are dropped. No documents: no shard and no row.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, narrow_batches, new_path, read_table, staged
from .word_ids import TEXTS_AT_ONCE, word_ids

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 256
END_ID = 1
MANIFEST = "shard int, n_docs long, n_tokens long"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Writes one shard; holds at most one record batch of ids."""

    def __init__(self, folder: str, shard: int, sequence: int, dtype: str):
        self.fs, self.root = store_of(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.name, self.attempt = f"{self.root}/{shard:06d}", uuid.uuid4().hex
        self.sequence, self.dtype, self.pending, self.held = sequence, dtype, [], 0
        ids = pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), sequence)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), sequence))])
        self.sink = self.fs.open_output_stream(f"{self.name}.{self.attempt}.tmp")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.sequence * SEQUENCES_PER_BATCH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, self.dtype)
        rows = -(-len(ids) // self.sequence) if last else len(ids) // self.sequence
        n = min(len(ids), rows * self.sequence)
        self.pending, self.held = [ids[n:]], len(ids) - n
        flat = np.zeros(rows * self.sequence, self.dtype)
        flat[:n] = ids[:n]
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (flat, np.arange(len(flat)) < n)]
        for k in range(0, rows, SEQUENCES_PER_BATCH):
            self.writer.write_batch(pa.RecordBatch.from_arrays([c.slice(k, SEQUENCES_PER_BATCH) for c in columns], schema=self.schema))

    def close(self) -> tuple[int, int]:
        if self.held:
            self._flush(True)
        self.writer.close()
        self.sink.close()
        lengths = np.array([n for _, n in self.docs], np.int64)
        table = pa.table({"doc_id": pa.array([d for d, _ in self.docs], pa.int64()), "start": np.cumsum(lengths) - lengths, "n_tokens": lengths})
        with self.fs.open_output_stream(f"{self.name}.docs.{self.attempt}.tmp") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
        for kind in ("docs.", ""):
            self.fs.move(f"{self.name}.{kind}{self.attempt}.tmp", f"{self.name}.{kind}arrow")
        return len(lengths), int(lengths.sum())


def write_token_files(docs: DataFrame, folder: str, sequence: int = SEQUENCE, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Encode documents (doc_id, text) in ascending doc_id order; returns the manifest
    (shard, n_docs, n_tokens, first_token), a staged table."""
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, shard, writer = word_ids(tokenizer), TaskContext.get().partitionId(), None
        dtype = "uint16" if words.tokenizer.get_vocab_size() <= 1 << 16 else "uint32"
        for whole in batches:
            for batch in by_size(whole, "text", TEXTS_AT_ONCE):
                writer = writer or ShardWriter(folder, shard, sequence, dtype)
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode_batch(batch.column("text")), strict=True):
                    writer.add(doc_id, np.append(ids, end_id).astype(dtype))
        if writer:
            n_docs, n_tokens = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n_docs]), pa.array([n_tokens])], names=["shard", "n_docs", "n_tokens"])

    narrow_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The keys that Spark samples for its ranges are two integers; no text goes to the driver.
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = plain.repartitionByRange(*by).sortWithinPartitions(*by, "text")
    shards = staged(ordered.mapInArrow(write, MANIFEST), "manifest")
    # One row a shard: the running sum is over as many rows as the write had tasks.
    first, rows = 0, []
    for r in sorted(shards.collect(), key=lambda r: r["shard"]):
        rows.append((r["shard"], r["n_docs"], r["n_tokens"], first))
        first += r["n_tokens"]
    return spark.createDataFrame(rows, MANIFEST + ", first_token long")


def open_shard(folder: str, shard: int) -> tuple[pa.ipc.RecordBatchFileReader, pa.Table]:
    """The sequences of a shard (memory-mapped where the store is local) and its documents."""
    store, root = store_of(folder)

    def source(name: str) -> pa.NativeFile:
        path = f"{root}/{shard:06d}.{name}"
        return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)

    with pa.ipc.open_file(source("docs.arrow")) as docs:
        return pa.ipc.open_file(source("arrow")), docs.read_all()


def sequences(reader: pa.ipc.RecordBatchFileReader) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and mask of each record batch as (rows, sequence) arrays; the ids are a view."""
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids, mask = batch.column("ids"), batch.column("mask")
        shape = (batch.num_rows, ids.type.list_size)
        yield ids.flatten().to_numpy().reshape(shape), mask.flatten().to_numpy(zero_copy_only=False).reshape(shape)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (over all shards), n_tokens and ids (binary, little-endian unsigned
    32-bit) of each document, read from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first in zip(batch.column("shard").to_pylist(), batch.column("first_token").to_pylist(), strict=True):
                reader, docs = open_shard(folder, shard)
                parts = sequences(reader)
                held = np.zeros(0, "<u4")
                for chunk in docs.to_batches(max_chunksize=256):
                    lengths = chunk.column("n_tokens").to_numpy()
                    need, got = int(lengths.sum()), [held]
                    have = len(held)
                    while have < need:
                        ids, mask = next(parts)
                        got.append(ids[mask].astype("<u4"))
                        have += len(got[-1])
                    flat = np.concatenate(got)
                    ends = np.cumsum(lengths)
                    ids = [flat[b - n : b].tobytes() for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                    held = flat[need:]
                    start = pa.array(chunk.column("start").to_numpy() + first)
                    yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), start, chunk.column("n_tokens"), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    spread = manifest.repartition(max(1, manifest.count()), "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), folder)
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
