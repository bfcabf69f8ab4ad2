"""Keyed Parquet tables, and JSON reports.

A table without partitions is a folder of numbered versions; the current one is the last
that Spark has finished (its ``_SUCCESS`` is there), so that a crash leaves the one before
it, and two writers that began from the same version can't both write the next. A table
with partitions is a log of manifests over folders of partitions; an upsert makes those that
it touches anew and names the others again. Its partition columns follow from the keys."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import store

KEPT_VERSIONS = 2


def folder_of(spark: SparkSession, path: str):
    """Hadoop's file system and path."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; on a local master without one, a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that all that follows sees the
    same rows, however often it reads them and whatever executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Conflict(Exception):
    """Another writer has made the version that this one was to make."""


def _value(folder: str) -> str | None:
    """The value in the name of a partition's folder, as Spark writes it."""
    value = folder.split("=", 1)[1]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)


class Table:
    """A keyed table. With ``partition_by``, each version is a manifest: a line for each
    partition with its values and its folder under ``data``. A writer writes new folders
    aside, then its manifest under a name of its own, and renames that to the next version's
    name, which fails if it is taken: readers see a version whole or not at all, and of two
    writers from one version the second gets ``Conflict`` and may begin anew."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], partition_by: list[str] | None = None):
        self.spark, self.path, self.schema, self.keys, self.partition_by = spark, path, schema, keys, partition_by or []

    @property
    def columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def versions(self) -> list[int]:
        if self.partition_by:
            return sorted(int(n[2:-5]) for n in self._names(f"{self.path}/log") if n.startswith("v-") and n.endswith(".json"))
        done = [n for n in self._names(self.path) if n.startswith("v-") and folder_of(self.spark, f"{self.path}/{n}/_SUCCESS")[0].exists(folder_of(self.spark, f"{self.path}/{n}/_SUCCESS")[1])]
        return sorted(int(n[2:]) for n in done)

    def _names(self, path: str) -> list[str]:
        files, root = folder_of(self.spark, path)
        return [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []

    def manifest(self, version: int) -> dict[tuple[str | None, ...], str]:
        """Values of the partition columns, as text, -> folder."""
        if not version:
            return {}
        lines = self.spark.read.text(f"{self.path}/log/v-{version:09d}.json").collect()  # a line a partition
        return {tuple(entry["values"]): entry["folder"] for entry in (json.loads(r["value"]) for r in lines if r["value"])}

    def read(self, version: int | None = None, partitions: Callable[[tuple[str | None, ...]], bool] | None = None) -> DataFrame:
        """The current rows, or a version's; with ``partitions``, of those only whose values,
        as text, it accepts."""
        version = version if version is not None else (self.versions() or [0])[-1]
        if not self.partition_by:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/v-{version:09d}") if version else self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/data/{f}" for values, f in self.manifest(version).items() if partitions is None or partitions(values)]
        # Files hold all columns: no values are taken from the folders' names.
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, since: int | None = None) -> None:
        """The next version after ``since``, else after the present one; ``Conflict`` (or the
        file system's error) if another writer has made it since ``rows`` were planned."""
        version = since if since is not None else (self.versions() or [0])[-1]
        if self.partition_by:
            return self._commit(version, {}, *self._write_partitions(rows))
        rows.select(*[c for c in self.columns if c in rows.columns]).write.mode("errorifexists").parquet(f"{self.path}/v-{version + 1:09d}")
        for old in self.versions()[:-KEPT_VERSIONS]:
            self._drop(f"{self.path}/v-{old:09d}")

    def _write_partitions(self, rows: DataFrame) -> tuple[str, dict[tuple[str | None, ...], str]]:
        """A new folder, and the partitions in it. Rows without a value of a partition column
        are a partition too."""
        folder = uuid.uuid4().hex
        shown = {f"_by_{c}": F.col(c).cast("string") for c in self.partition_by}
        rows.select(*self.columns).withColumns(shown).write.partitionBy(*shown).parquet(f"{self.path}/data/{folder}")
        made: dict[tuple[str | None, ...], str] = {(): folder}
        for column in shown:
            made = {(*values, _value(n)): f"{f}/{n}" for values, f in made.items() for n in self._names(f"{self.path}/data/{f}") if n.startswith(f"{column}=")}
        return folder, made

    def _commit(self, version: int, kept: dict[tuple[str | None, ...], str], folder: str, made: dict[tuple[str | None, ...], str]) -> None:
        jvm = self.spark.sparkContext._jvm
        log, name = f"{self.path}/log", f"v-{version + 1:09d}.json"
        text = "".join(json.dumps({"values": v, "folder": f}) + "\n" for v, f in (kept | made).items())
        aside = folder_of(self.spark, f"{log}/{folder}.new")
        out = aside[0].create(aside[1], False)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside[1].toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(aside[1], folder_of(self.spark, f"{log}/{name}")[1], self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as failed:
            self._drop(f"{log}/{folder}.new")
            self._drop(f"{self.path}/data/{folder}")
            raise Conflict(f"{self.path}: version {version + 1} was made by another writer") from failed
        self._forget()

    def _forget(self) -> None:
        """Drop the manifests before the last ones, and folders that only they name."""
        versions = self.versions()
        old, kept = versions[:-KEPT_VERSIONS], versions[-KEPT_VERSIONS:]
        if old:
            live = {f for v in kept for f in self.manifest(v).values()}
            for version in old:
                for gone in set(self.manifest(version).values()) - live:
                    self._drop(f"{self.path}/data/{gone}")
                self._drop(f"{self.path}/log/v-{version:09d}.json")

    def _drop(self, path: str) -> None:
        files, found = folder_of(self.spark, path)
        files.delete(found, True)

    def upsert(self, source: DataFrame, now: str, order: Column | None = None) -> tuple[int, int]:
        """(inserted, updated), counted by the write itself. Of a key's source rows the last by
        ``order`` counts. With partitions, those of touched ones only are read and made."""
        source = store.one_per_key(source, self.keys, order)
        version, counts = (self.versions() or [0])[-1], Observation()
        observed = (F.count_if("_inserted").alias("inserted"), F.count_if("_updated").alias("updated"))
        if not self.partition_by:
            rows = store.upsert(self.read(version), source, self.keys, now).observe(counts, *observed)
            self.replace(rows.drop("_inserted", "_updated"), version)
            return counts.get["inserted"], counts.get["updated"]
        source = staged(source, "upsert")
        # As many rows as partitions are touched.
        touched = {tuple(r) for r in source.select(*[F.col(c).cast("string") for c in self.partition_by]).distinct().collect()}
        held = self.read(version, touched.__contains__)
        rows = store.upsert(held, source, self.keys, now).observe(counts, *observed)
        folder, made = self._write_partitions(rows)
        self._commit(version, self.manifest(version), folder, made)
        return counts.get["inserted"], counts.get["updated"]

    def insert_ignore(self, source: DataFrame, order: Column | None = None) -> None:
        version = (self.versions() or [0])[-1]
        self.replace(store.insert_ignore(self.read(version), source, self.keys, order), version)

    def append(self, source: DataFrame, dedupe: bool = False) -> None:
        version = (self.versions() or [0])[-1]
        self.replace(store.append(self.read(version), source, self.keys if dedupe else None), version)

    def retain(self, ts: str, now: str, hours: int = 48) -> None:
        version = (self.versions() or [0])[-1]
        self.replace(store.retained(self.read(version), ts, now, hours), version)


def record_failures(table: Table, failed: DataFrame, now: str) -> None:
    """Failed intervals (symbol, interval_start, interval_end, reason) into their table; one
    that is there already stays as it is."""
    stamp = F.lit(now).cast("timestamp")
    table.insert_ignore(failed.withColumns({"createdAt": stamp, "updatedAt": stamp}), F.col("reason"))


def report_maps(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(value): a JSON map of a symbol to its ranges, by start; dates as text. A row a symbol."""
    shown = [F.col(c).cast("string").alias(c) if c in ("start", "end", "last_actual_date") else F.col(c) for c in fields]
    ranges = rows.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct(*shown))).alias("ranges"))
    return ranges.select(F.to_json(F.create_map(F.col("symbol").cast("string"), "ranges")).alias("value"))


def write_report(rows: DataFrame, path: str, fields: list[str], keep_if_empty: bool = True) -> bool:
    """Write the report as lines that ``readers.gap_report`` reads, each a map. It is written
    aside and then put in place, so that ``rows`` may come from the report itself. Without
    rows nothing is written, and an earlier report stays (or goes, if not ``keep_if_empty``)."""
    spark, aside = rows.sparkSession, f"{path}-{uuid.uuid4().hex}"
    report_maps(rows, fields).write.text(aside)
    files, new = folder_of(spark, aside)
    empty = spark.read.text(aside).isEmpty()
    if empty and keep_if_empty:
        files.delete(new, True)
        return False
    files.delete(folder_of(spark, path)[1], True)
    files.delete(new, True) if empty else files.rename(new, folder_of(spark, path)[1])
    return not empty
