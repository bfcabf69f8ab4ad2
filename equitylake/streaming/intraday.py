"""Structured Streaming of market snapshots."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.calendars import is_open
from ..functions.scalars import minute_floor
from ..plans.jobs import watch_pages
from ..sources.tables import Table

# Of time as the state holds it: microseconds of a minute, minutes of a day and to local time.
MINUTE, DAY, LOCAL_SHIFT = 60_000_000, 1440, 300


def snapshots(spark: SparkSession, path: str, schema: str, per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def during_trading(stream: DataFrame, ts: str = "scraped_at") -> DataFrame:
    """Rows from trading hours only; nothing sleeps."""
    return stream.where(is_open(F.col(ts)))


def minute_bars(stream: DataFrame, late: str = "48 hours") -> DataFrame:
    """The last snapshot of each symbol and minute; the watermark only bounds the state."""
    watermarked = stream.withWatermark("scraped_at", late)
    return watermarked.groupBy("symbol", F.window("scraped_at", "1 minute")).agg(F.max_by("volume", "scraped_at").alias("volume")).select("symbol", F.col("window.start").alias("bucket"), "volume")


def plain(at: Any) -> dt.datetime:
    return pd.Timestamp(at).to_pydatetime()


class VolumeDelta(StatefulProcessor):
    """Per symbol a list of minutes with volumes, read and put whole: a call of the state store
    each. Of a batch's snapshots of a minute the last counts; it overwrites what the minute
    held, also when later minutes are there already, whose deltas stay as they were derived.
    With a time to live a minute is dropped that long after it was written, and the list that
    long after it was put; else those behind the watermark go, but for the last of them."""

    def __init__(self, ttl_hours: int | None = None):
        self.ttl_hours = ttl_hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        lives = {} if self.ttl_hours is None else {"ttlDurationMs": int(self.ttl_hours * 3_600_000)}
        self.minutes = handle.getListState("minutes", "minute long, volume long, written long", **lives)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        latest: dict[int, tuple] = {}  # a minute's last snapshot; as many as minutes
        for frame in rows:
            times = frame["scraped_at"].to_numpy("datetime64[us]").astype("int64").tolist()
            for now, volume in zip(times, frame["volume"].tolist()):
                minute = now // MINUTE
                if minute not in latest or now >= latest[minute][0]:
                    latest[minute] = (now, None if pd.isna(volume) else int(volume))
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_hours is not None else 0
        since = now - self.ttl_hours * 3_600_000 if self.ttl_hours is not None else 0
        held = {m: (None if v is None or pd.isna(v) else int(v), w) for m, v, w in self.minutes.get() if w >= since}
        held |= {minute: (volume, now) for minute, (_, volume) in latest.items()}
        known, out = sorted(held), []
        for minute in sorted(latest):
            place = bisect_left(known, minute)
            last = known[place - 1] if place else None
            volume, before = held[minute][0], held[last][0] if last is not None else None
            same_day = last is not None and (last + LOCAL_SHIFT) // DAY == (minute + LOCAL_SHIFT) // DAY
            counts = same_day and volume is not None and before is not None and volume >= before
            out.append((minute, volume, volume - before if counts else None))
        if self.ttl_hours is None:
            mark = timerValues.getCurrentWatermarkInMs()
            behind = [m for m in known if m * 60_000 < mark]
            for minute in behind[:-1]:
                del held[minute]
        self.minutes.put([(m, *held[m]) for m in sorted(held)])
        bucket, volume, delta = zip(*out, strict=True)
        at = (np.array(bucket, "int64") * MINUTE).astype("datetime64[us]")
        yield pd.DataFrame({"symbol": [key[0]] * len(out), "bucket": at, "volume": pd.array(volume, "Int64"), "volume_delta": pd.array(delta, "Int64")})

    def close(self) -> None:
        pass


def volume_deltas(stream: DataFrame, late: str = "48 hours", ttl_hours: int | None = None) -> DataFrame:
    """(symbol, bucket, volume, volume_delta) of a stream (symbol, scraped_at, volume): a row
    for each minute of each batch, which replaces an earlier one of its key. Snapshots later
    than ``late`` are dropped; with ``ttl_hours`` none are, and minutes are kept that long."""
    if ttl_hours is None:
        stream = stream.withWatermark("scraped_at", late)
    mode = "EventTime" if ttl_hours is None else "ProcessingTime"
    return stream.groupBy("symbol").transformWithStateInPandas(VolumeDelta(ttl_hours), "symbol string, bucket timestamp, volume long, volume_delta long", "Append", mode)


def stasis_cycles(rows: list[tuple[pd.Timestamp, int]], repeats: int = 3, minutes: int = 20, state: tuple | None = None) -> tuple[list[bool], tuple]:
    """For each (time, total) whether it reports a halt, and the state after it: (last total,
    how often in a row, since when). A report starts everything anew."""
    last, n, since = state or (None, 0, None)
    out = []
    for at, total in rows:
        n = n + 1 if total == last and total else int(bool(total))
        last = total
        since = at if n == repeats else since if n > repeats else None
        halted = since is not None and at - since >= pd.Timedelta(minutes=minutes)
        out.append(halted)
        if halted:
            last, n, since = None, 0, None
    return out, (last, n, since)


class Stasis(StatefulProcessor):
    """Per market the run of equal totals, and the cycles that the watermark has not passed.

    A timer at each cycle takes it in the order of time, whatever the order of arrival; a
    timer at the end of the ``minutes`` reports the halt, whether a cycle comes or not. At
    the same time a cycle comes first. One row of state a market, and the waiting cycles."""

    def __init__(self, repeats: int, minutes: int):
        self.repeats, self.minutes = repeats, minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "last long, n int, since timestamp")
        self.waiting = handle.getMapState("waiting", "cycle_ts timestamp", "total long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for at, total in zip(frame["cycle_ts"], frame["total"]):
                at = pd.Timestamp(at).floor("ms")
                self.waiting.updateValue((plain(at),), (int(total),))
                self.handle.registerTimer(int(at.value // 1_000_000))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        last, n, since = self.run.get() if self.run.exists() else (None, 0, None)
        since = None if since is None or pd.isna(since) else pd.Timestamp(since)
        out = []
        if self.waiting.containsKey((plain(now),)):
            total = int(self.waiting.getValue((plain(now),))[0])
            self.waiting.removeKey((plain(now),))
            n = n + 1 if total == last and total else int(bool(total))
            last = total
            since = now if n == self.repeats else since if n > self.repeats else None
            out.append((key[0], now, total, False))
        due = None if since is None else since + pd.Timedelta(minutes=self.minutes)
        if due is not None and due > max(now, pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")):
            self.handle.registerTimer(int(due.value // 1_000_000))
        elif due is not None and not any(pd.Timestamp(k[0]) <= due for k in self.waiting.keys()):
            out.append((key[0], due, last, True))
            last, n, since = None, 0, None
        self.run.update((last, n, None if since is None else plain(since)))
        yield pd.DataFrame(out, columns=["market", "cycle_ts", "total", "halted"])

    def close(self) -> None:
        pass


def halts(cycles: DataFrame, repeats: int = 3, minutes: int = 20, late: str = "0 seconds") -> DataFrame:
    """(market, cycle_ts, total, halted) of a stream (market, cycle_ts, total): a row for each
    cycle that the watermark, ``late`` behind the last cycle of any market, has passed, and
    one with ``halted`` at the time of each report, whether or not there is a cycle then."""
    marked = cycles.withWatermark("cycle_ts", late)
    return marked.groupBy("market").transformWithStateInPandas(Stasis(repeats, minutes), "market string, cycle_ts timestamp, total long, halted boolean", "Append", "EventTime")


def write_upserts(stream: DataFrame, table: Table, checkpoint: str, order: str = "scraped_at", trigger: dict | None = None, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Each batch upserts the last row of each key; a repeated batch changes nothing."""

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        if now := batch.agg(F.max(order).cast("string")).first()[0]:
            table.upsert(batch, now, F.col(order))
        batch.unpersist()
        if after:
            after(batch, number)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "90 seconds"})).start()


def poll_watch(pages: DataFrame, table: Table, checkpoint: str, trigger: dict | None = None, report: Callable[[dict], None] | None = None) -> StreamingQuery:
    """The market-watch job: a stream of pages (html, scraped_at) to quotes, volume deltas
    and keyed upserts; ``report`` gets each cycle's counts."""

    def put(batch: DataFrame, number: int) -> None:
        done = watch_pages(batch, table)
        if report:
            report(done)

    return pages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "90 seconds"})).start()


def with_minute(stream: DataFrame) -> DataFrame:
    return stream.withColumn("scraped_at_minute", minute_floor(F.col("scraped_at")))
