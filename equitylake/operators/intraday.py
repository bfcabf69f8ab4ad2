"""Snapshots of the market within a day, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import local_date
from . import ranks

BLOCK = 65_536


def latest_per_bucket(snapshots: DataFrame, unit: str = "minute") -> DataFrame:
    """(symbol, bucket, ts, seq, volume): of snapshots (symbol, ts, seq, volume) the last of
    each bucket, its null volume included. Combined before the shuffle; no sort."""
    at = F.struct("ts", "seq")
    last = snapshots.groupBy("symbol", F.date_trunc(unit, "ts").alias("bucket")).agg(F.max_by(F.struct("ts", "seq", "volume"), at).alias("_r"))
    return last.select("symbol", "bucket", "_r.ts", "_r.seq", "_r.volume")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """(symbol, ts, seq, volume): the last of each symbol."""
    last = snapshots.groupBy("symbol").agg(F.max_by(F.struct("ts", "seq", "volume"), F.struct("ts", "seq")).alias("_r"))
    return last.select("symbol", "_r.ts", "_r.seq", "_r.volume")


def volume_delta(buckets: DataFrame) -> DataFrame:
    """``buckets`` (symbol, bucket, volume) with volume_delta against the symbol's bucket
    before; null for a first one, a null on either side, another local date or a fall."""
    before = Window.partitionBy("symbol").orderBy("bucket")
    last, at = F.lag("volume").over(before), F.lag("bucket").over(before)
    delta = F.when((local_date(F.col("bucket")) == local_date(at)) & (F.col("volume") >= last), F.col("volume") - last)
    return buckets.withColumn("volume_delta", delta)


def cycle_rows(stored: DataFrame, quotes: DataFrame) -> DataFrame:
    """The rows that a poll cycle upserts: of quotes (symbol, scraped_at, volume, others) the
    last of each minute, with scraped_at_minute and volume_delta against the minute before
    it, stored (symbol, scraped_at_minute, volume) or of the same cycle. Stored rows of
    other symbols and of the same minutes play no part."""
    minute = F.date_trunc("minute", "scraped_at")
    others = F.struct(*[c for c in quotes.columns if c != "symbol"])
    last = quotes.groupBy("symbol", minute.alias("scraped_at_minute")).agg(F.max_by(others, F.struct("scraped_at", "volume")).alias("_r"))
    new = last.select("symbol", "scraped_at_minute", F.col("_r.volume").alias("volume"), F.col("_r"))
    keys = new.select("symbol", "scraped_at_minute")
    old = stored.join(keys.select("symbol").distinct(), "symbol", "left_semi").join(keys, ["symbol", "scraped_at_minute"], "left_anti")
    both = new.unionByName(old.select("symbol", "scraped_at_minute", "volume"), allowMissingColumns=True)
    found = volume_delta(both.withColumnRenamed("scraped_at_minute", "bucket")).where("_r is not null")
    return found.select("symbol", F.col("bucket").alias("scraped_at_minute"), *[F.col(f"_r.{c}").alias(c) for c in quotes.columns if c != "symbol"], "volume_delta")


def total_volume(snapshots: DataFrame, by: str = "bucket") -> DataFrame:
    return snapshots.groupBy(by).agg(F.sum(F.coalesce("volume", F.lit(0))).alias("total_volume"))


def stasis(cycles: DataFrame, repeats: int = 3, minutes: int = 20, market: str | None = None) -> DataFrame:
    """``cycles`` (cycle_ts, total) with run_start and stale: a run of equal totals other
    than 0 is stale from ``minutes`` after its ``repeats``-th cycle on.

    This marks every cycle of a halt; the streaming form also starts anew after each report.
    With a ``market`` column each market's cycles are one window. Without one all cycles are
    one sequence: they are numbered by ranges of time, and each looks back at the cycle
    numbered one less, so that no window holds more than a run."""
    if market:
        by = Window.partitionBy(market).orderBy("cycle_ts")
        changed = F.coalesce(F.col("total") != F.lag("total").over(by), F.lit(True))
        runs, keys = cycles.withColumn("_run", F.sum(changed.cast("int")).over(by)), [market, "_run"]
    else:
        placed = ranks.numbered(cycles, [F.col("cycle_ts").asc()], "_place")
        before = placed.select((F.col("_place") + 1).alias("_place"), F.col("total").alias("_last"))
        begins = placed.join(before, "_place", "left").withColumn("_begins", F.coalesce(F.col("total") != F.col("_last"), F.lit(True)))
        # A run's number is the place where it begins: the last beginning at or before a cycle,
        # found within blocks of places, then among the blocks.
        block = F.floor(F.col("_place") / BLOCK)
        inside = Window.partitionBy("_block").orderBy("_place")
        marked = begins.withColumn("_block", block).withColumn("_run", F.max(F.when(F.col("_begins"), F.col("_place"))).over(inside))
        ends = marked.groupBy("_block").agg(F.max("_run").alias("_end"))
        carried = ends.select("_block", F.max("_end").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))  # a row a block
        runs = marked.join(carried, "_block").withColumn("_run", F.coalesce("_run", "_carried")).drop("_place", "_last", "_begins", "_block", "_carried")
        keys = ["_run"]
    inside = Window.partitionBy(*keys).orderBy("cycle_ts")
    timed = runs.withColumn("_n", F.row_number().over(inside)).withColumn("run_start", F.min(F.when(F.col("_n") == repeats, F.col("cycle_ts"))).over(inside))
    stale = (F.col("total") != 0) & (F.col("_n") >= repeats) & (F.unix_timestamp("cycle_ts") - F.unix_timestamp("run_start") >= minutes * 60)
    return timed.withColumn("stale", F.coalesce(stale, F.lit(False))).drop("_run", "_n")
