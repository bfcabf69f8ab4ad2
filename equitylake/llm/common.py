"""What the operators of this folder share: tables, the shared folder, staging."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import narrow_batches  # noqa: F401  the operators take it from here

_LOCAL_DIRS: dict[str, str] = {}
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u00a0\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u2026"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and all executors see.

    Only a local master may do without the setting: there a temporary folder serves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _LOCAL_DIRS[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later plans start from
    the table, so that a lost executor costs the tasks that it ran and no more."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later plan reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_WORKER_CACHE: dict[str, Any] = {}


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one thing at a time. Workers outlive
    an operator's tasks, so that the next operator's first call drops what the last kept."""
    if name not in _WORKER_CACHE:
        drop_cache()
        _WORKER_CACHE[name] = make()
    return _WORKER_CACHE[name]


def drop_cache() -> None:
    """Give back what other operators' tasks have left in this Python worker; tasks of
    operators without a cache begin with it."""
    _WORKER_CACHE.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def by_size(batch: pa.RecordBatch, column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts, bytes or lists of 32 bits have about ``most`` bytes together,
    one row at least."""
    held = batch.column(column)
    listed = pa.types.is_list(held.type) or pa.types.is_large_list(held.type)
    sizes = pc.multiply(pc.list_value_length(held), 4) if listed else pc.binary_length(held)
    sizes = sizes.fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def row_key() -> tuple[Column, Column]:
    """128 bits that rows (doc_id, text) share only if both are equal, nulls included."""
    parts = (F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text").cast("string"))
    return F.xxhash64(F.lit("first"), *parts), F.xxhash64(F.lit("second"), *parts)


def salt_of(salts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)).cast("int")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of a batch, the word at each position as an index into them,
    and where each text's words begin and end. White space is Unicode's; a text that
    begins or ends with it yields the word ``""`` there."""
    lists = pc.utf8_split_whitespace(texts.cast(pa.string()).fill_null(""))
    words = lists.flatten().dictionary_encode()
    bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    return words.dictionary, words.indices.to_numpy(), bounds.astype(np.int64)


def word_places(words: list[str] | pa.Array, size: int) -> np.ndarray:
    """Each word's place among ``size`` hashed features, -1 where nothing is left of it.
    Words are lower-cased and stripped of ``MARKS`` at both ends."""
    plain = pc.utf8_trim(pc.utf8_lower(pa.array(words, pa.string())), characters=MARKS)
    places = (hashes_of(plain) % np.uint64(size)).astype(np.int64)
    return np.where(pc.equal(plain, "").to_numpy(zero_copy_only=False), -1, places)


_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


def hashes_of(words: pa.Array, runs_once: bool = False) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' sum, each times a fixed odd number for its
    place. ``runs_once``: equal bytes one after another count as one."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    if not lengths.any():
        return np.zeros(len(words), np.uint64)
    _, offsets, data = words.buffers()
    first = np.frombuffer(offsets, np.int32)[words.offset]
    bytes_ = np.frombuffer(data, np.uint8)[first : first + int(lengths.sum())]
    starts = np.cumsum(lengths) - lengths
    if runs_once:
        new = np.append(True, bytes_[1:] != bytes_[:-1])
        new[starts[lengths > 0]] = True
        upto = np.append(0, np.cumsum(new))
        bytes_, lengths, starts = bytes_[new], upto[starts + lengths] - upto[starts], upto[starts]
    place = np.arange(len(bytes_)) - np.repeat(starts, lengths)
    values = bytes_.astype(np.uint64) + np.uint64(1)
    values *= _MULTIPLIERS[place & 4095]
    sums, held = np.zeros(len(words), np.uint64), lengths > 0
    sums[held] = np.add.reduceat(values, starts[held])
    sums ^= sums >> np.uint64(32)
    sums *= np.uint64(0x9E3779B97F4A7C15)
    return sums ^ sums >> np.uint64(29)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of links (a, b), component being the smallest node.

    Large-star and small-star steps in turn: each round links a node's larger, then its
    smaller neighbours to the smallest of them, until nothing changes. Each round starts
    from a table in the shared folder. Minima are combined before they are shuffled, and
    Spark may split the join of a node that has many neighbours."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, last = staged(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small, "edges")


CHUNK = 8192


def in_chunks(values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """An array of doubles as rows (chunk, data) of ``CHUNK`` of them, those of zeros left out."""
    for first in range(0, len(values), 64 * CHUNK):
        parts = [(k // CHUNK, values[k : k + CHUNK].astype("<f8")) for k in range(first, min(first + 64 * CHUNK, len(values)), CHUNK)]
        parts = [(k, part.tobytes()) for k, part in parts if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["chunk", "data"])


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all arrays of ``size`` doubles that tasks gave in_chunks; chunks are summed
    by tasks, and the driver sees one array."""

    def add(table: pa.Table) -> pa.Table:
        total = functools.reduce(np.add, (np.frombuffer(x.as_py(), "<f8") for x in table.column("data")))
        return pa.table({"chunk": table.column("chunk")[:1].cast(pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(size)
    for row in parts.groupBy("chunk").applyInArrow(add, "chunk int, data binary").collect():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["data"], "<f8")
    return out
