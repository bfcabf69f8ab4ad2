"""Pages as Spark data sources, planned from a table of what to fetch.

``exchange_pages`` (batch): one partition for each file of the worklist's staged rows
(symbol, year, month). Filters on these columns are pushed into the source and taken before
a page is fetched. ``exchange_schedule`` (stream): the keys of a numbered worklist, some in
each batch; tasks then fetch their pages, so that pages never pass the driver.

A fetcher is ``module:function``, called as ``fetch(where, *key) -> str | None`` with the
source's option ``where`` and the key's values. Failed pages are left out. Threads and pauses
of a client belong to the fetcher."""

from __future__ import annotations

import functools
import importlib
import posixpath
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from ..operators import ranks
from .tables import scratch_path

MONTH = ("symbol", "year", "month")
# Bytes of recorded pages that a worker reads at once, pages that it hands on at once, and
# how many neighbours in a schedule go to one task.
SHELF_BYTES, PAGES, NEIGHBOURS = 2 << 20, 100, 500
COMPARE = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}


def files_of(path: str) -> list[str]:
    """The Parquet files in a folder, by name; none if there is no folder."""
    files, root = pafs.FileSystem.from_uri(path)
    found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(f"{path}/{posixpath.basename(f.path)}" for f in found if f.path.endswith(".parquet"))


def read_file(path: str, columns: list[str]) -> pa.Table:
    files, inner = pafs.FileSystem.from_uri(path)
    return pq.read_table(inner, filesystem=files, columns=columns)


def batches_of(path: str, columns: list[str], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    files, inner = pafs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as opened:
        yield from pq.ParquetFile(opened).iter_batches(batch_size=rows, columns=columns)


def fetcher_of(name: str) -> Callable[..., str | None]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.worklist, self.fetcher, self.where = options["worklist"], options["fetcher"], options.get("where", "")
        self.pushed: list[tuple[str, Any, Any]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            if isinstance(one, (*COMPARE, In)) and one.attribute[0] in MONTH:
                self.pushed.append((one.attribute[0], type(one), one.value))
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        return [File(f) for f in files_of(self.worklist)]

    def wanted(self, path: str) -> Iterator[tuple[str, int, int]]:
        for rows in batches_of(path, list(MONTH)):
            for column, kind, value in self.pushed:
                held = rows.column(column)
                mask = pc.is_in(held, pa.array(list(value), held.type)) if kind is In else COMPARE[kind](held, pa.scalar(value, held.type))
                rows = rows.filter(mask)
            yield from zip(*(rows.column(c).to_pylist() for c in MONTH), strict=True)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch = fetcher_of(self.fetcher)
        for key in self.wanted(partition.path):
            html = fetch(self.where, *key)
            if html is not None:
                yield *key, html


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exchange_pages"

    def schema(self) -> str:
        return "symbol string, year int, month int, html string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


def months_to_fetch(ranges: DataFrame) -> DataFrame:
    """(symbol, year, month) of ranges (symbol, start, end): each month that one touches, once."""
    first, last = F.trunc("start", "month"), F.trunc("end", "month")
    months = ranges.where("start <= end").select(F.col("symbol").cast("string").alias("symbol"), F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("m")).distinct()
    return months.select("symbol", F.year("m").alias("year"), F.month("m").alias("month"))


def fetched_pages(worklist: DataFrame, fetcher: str, where: str = "", tasks: int | None = None) -> DataFrame:
    """(symbol, year, month, html) of a worklist (symbol, year, month), which is written to the
    shared folder in as many files as there are to be ``tasks``, at most: each holds a stretch of
    the keys in their order, so that what is fetched one after another lies together."""
    spark, path = worklist.sparkSession, scratch_path(worklist.sparkSession, "worklist")
    spark.dataSource.register(PageSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    typed = worklist.select(F.col("symbol").cast("string"), F.col("year").cast("int"), F.col("month").cast("int"))
    typed.repartitionByRange(tasks or spark.sparkContext.defaultParallelism, *MONTH).sortWithinPartitions(*MONTH).write.parquet(path)
    return spark.read.format("exchange_pages").options(worklist=path, fetcher=fetcher, where=where).load()


class ScheduleReader(SimpleDataSourceStreamReader):
    """Keys by number: an offset is the number of the next chunk, a batch one chunk. What a
    batch held is found again from its offsets, after a restart too."""

    def __init__(self, options: dict[str, str]):
        self.worklist, self.key = options["worklist"], options["key"]

    def initialOffset(self) -> dict:
        return {"chunk": 0}

    def rows(self, chunk: int) -> list[tuple]:
        return [r for f in files_of(f"{self.worklist}/chunk={chunk}") for r in zip(*read_file(f, ["place", self.key]).to_pydict().values(), strict=True)]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = self.rows(start["chunk"])
        return iter(found), {"chunk": start["chunk"] + (1 if found else 0)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return (r for chunk in range(start["chunk"], end["chunk"]) for r in self.rows(chunk))


class ScheduleSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exchange_schedule"

    def schema(self) -> str:
        return "place long, key string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return ScheduleReader(self.options)


def schedule(worklist: DataFrame, key: str, per_batch: int, path: str | None = None) -> str:
    """Write a worklist's keys in their order, ``per_batch`` to a chunk, for ``polled_pages``."""
    path = path or scratch_path(worklist.sparkSession, "schedule")
    keys = worklist.select(F.col(key).cast("string").alias("key"), F.col(key).alias("_order"))
    placed = ranks.numbered(keys, [F.col("_order").asc()], "place").select("place", "key", F.floor(F.col("place") / per_batch).alias("chunk"))
    placed.repartition("chunk").write.partitionBy("chunk").parquet(path)
    return path


def polled_pages(spark: SparkSession, path: str, fetcher: str, where: str = "") -> DataFrame:
    """(place, key, html): a stream of the pages of a ``schedule``, a chunk a batch. Only keys
    pass the driver; tasks fetch."""
    spark.dataSource.register(ScheduleSource)
    keys = spark.readStream.format("exchange_schedule").options(worklist=path, key="key").load()

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = fetcher_of(fetcher)
        for frame in frames:
            ordered = frame.sort_values("key")
            for k in range(0, len(ordered), PAGES):
                part = ordered.iloc[k : k + PAGES]
                pages = part.assign(html=[get(where, k) for k in part["key"]])
                yield pages[pages["html"].notna()]

    # Neighbours go to one task.
    return keys.repartition(spark.sparkContext.defaultParallelism, F.floor(F.col("place") / NEIGHBOURS)).mapInPandas(fetch, "place long, key string, html string")


@functools.lru_cache(maxsize=4)
def _shelves(path: str) -> tuple[list[str], list[tuple[str, int]]]:
    """The last key of each shelf in the order of keys, and where it is: file and row group."""
    last, places = [], []
    for name in files_of(path):
        files, inner = pafs.FileSystem.from_uri(name)
        footer = pq.read_metadata(inner, filesystem=files)
        for group in range(footer.num_row_groups):
            last.append(footer.row_group(group).column(0).statistics.max)
            places.append((name, group))
    return last, places


@functools.lru_cache(maxsize=4)
def _shelf(path: str, group: int) -> dict[str, str | None]:
    files, inner = pafs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as opened:
        rows = pq.ParquetFile(opened).read_row_group(group, columns=["key", "html"])
    return dict(zip(rows.column("key").to_pylist(), rows.column("html").to_pylist(), strict=True))


def record_pages(pages: DataFrame, shelf: int = SHELF_BYTES) -> str:
    """Keep pages (key string, html) where ``recorded_page`` finds them; returns the place. They
    lie in the order of their keys, in row groups of about ``shelf`` bytes; what has no key is
    never asked for."""
    path = scratch_path(pages.sparkSession, "recorded")
    keyed = pages.select("key", "html").where("key is not null")
    ordered = keyed.repartitionByRange("key").sortWithinPartitions("key")
    ordered.write.option("parquet.block.size", str(shelf)).option("parquet.page.size.row.check.min", "10").option("parquet.block.size.row.check.min", "10").option("parquet.block.size.row.check.max", "100").parquet(path)
    return path


def recorded_page(where: str, *key: Any) -> str | None:
    """A fetcher that answers from what ``record_pages`` kept, as if from the network; null for
    a page that is not there. A worker holds the last keys of the row groups, and the pages of
    the last few: keys that are asked for in their order read each once."""
    last, places = _shelves(where)
    name = "/".join(str(k) for k in key)
    at = bisect_left(last, name.encode() if last and isinstance(last[0], bytes) else name)
    return _shelf(*places[at]).get(name) if at < len(last) else None
