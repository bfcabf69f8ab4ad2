"""Calendars and market hours as expressions of dates and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scalars import LOCAL_OFFSET

Ranges = list[tuple[str, str]]

# Minutes of the local day at which trading opens and closes, by weekday
# (Monday 0); simple hours and hours with a Friday break.
SIMPLE_HOURS = {d: [(565, 930)] for d in range(5)}
FRIDAY_HOURS = {**{d: [(565, 955)] for d in range(4)}, 4: [(565, 721), (870, 1015)]}


def month_starts(start: Column, end: Column) -> Column:
    """First days of the months from start to end; only start's if end is earlier."""
    first = F.trunc(start, "month")
    return F.sequence(first, F.greatest(first, F.trunc(end, "month")), F.expr("interval 1 month"))


def business_days(start: Column, end: Column) -> Column:
    """Number of Mondays to Fridays from start to end, both included."""
    def upto(day: Column) -> Column:
        n = F.datediff(day, F.lit(dt.date(1899, 12, 31))) - 1  # days since Monday, 1 January 1900
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))

    return (upto(end) - upto(F.date_sub(start, 1))).cast("int")


def business_calendar(spark: SparkSession, start: str, end: str, exclusions: Ranges | DataFrame | None = None) -> DataFrame:
    """(date): Mondays to Fridays, without any excluded range (inclusive). One row a day."""
    ends = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last"))
    return _business(ends, exclusions)


def calendar_of(history: DataFrame, exclusions: Ranges | DataFrame | None = None) -> DataFrame:
    """The business calendar from the first to the last date of ``history``."""
    return _business(history.agg(F.min("date").alias("first"), F.max("date").alias("last")), exclusions)


def _business(ends: DataFrame, exclusions: Ranges | DataFrame | None) -> DataFrame:
    days = ends.select(F.explode(F.sequence("first", "last")).alias("date")).where(F.weekday("date") < 5)
    if exclusions is None or isinstance(exclusions, list) and not exclusions:
        return days
    if isinstance(exclusions, list):
        exclusions = ends.sparkSession.createDataFrame(exclusions, "start string, end string").select(*[F.col(c).cast("date") for c in ("start", "end")])
    return outside(days, exclusions)


def monthly(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """``ranges`` (keys, start, end) cut at the ends of months, column ``month``. A range with
    a null or that ends before it starts holds no day."""
    held = ranges.where("start <= end").select(*keys, "start", "end", F.explode(month_starts(F.col("start"), F.col("end"))).alias("month"))
    return held.select(*keys, "month", F.greatest("start", "month").alias("start"), F.least("end", F.last_day("month")).alias("end"))


def merged_ranges(ranges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, month, start, end): the days of ``ranges`` (keys, start, end) as ranges that
    neither overlap nor touch, within each month: a month's are at most sixteen."""
    keys = keys or []
    order = Window.partitionBy(*keys, "month").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > F.date_add(reach, 1), F.lit(True)).cast("int")
    numbered = monthly(ranges, keys).withColumn("_new", begins).withColumn("_run", F.sum("_new").over(order))
    return numbered.groupBy(*keys, "month", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def outside(days: DataFrame, ranges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``days`` (keys, date, ...) that lie in none of ``ranges`` (keys, start, end), which may
    overlap: a join on the keys and the month, in which few ranges are left to look at.
    Without keys a range holds for all days. Days with a null date stay."""
    keys = keys or []
    cut = merged_ranges(ranges, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("month").alias("_month"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    same = F.trunc("date", "month") == F.col("_month")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return days.join(cut, same & F.col("date").between(F.col("_start"), F.col("_end")), "left_anti")


def seconds_until_open(ts: Column, hours: dict[int, list[tuple[int, int]]] = FRIDAY_HOURS) -> Column:
    """0 while the market is open at UTC timestamp ``ts``, else seconds to the next opening."""
    local = F.from_utc_timestamp(ts, LOCAL_OFFSET)
    minute = F.hour(local) * 60 + F.minute(local)
    second = minute * 60 + F.second(local)
    out = F.lit(None).cast("int")
    for day in range(7):
        today = hours.get(day, [])
        ahead = next((k for k in range(1, 8) if hours.get((day + k) % 7)), None)
        wait = F.lit(None).cast("int") if ahead is None else F.lit(ahead * 86400 + hours[(day + ahead) % 7][0][0] * 60) - second
        for begin, end in reversed(today):
            wait = F.when(minute < begin, F.lit(begin * 60) - second).when(minute < end, F.lit(0)).otherwise(wait)
        out = F.when(F.weekday(local) == day, wait).otherwise(out)
    return out


def is_open(ts: Column, hours: dict[int, list[tuple[int, int]]] = FRIDAY_HOURS) -> Column:
    return seconds_until_open(ts, hours) == 0


def session_close(ts: Column, hours: dict[int, list[tuple[int, int]]] = FRIDAY_HOURS) -> Column:
    """UTC timestamp at which the session that holds ``ts`` closes; null if closed."""
    local = F.from_utc_timestamp(ts, LOCAL_OFFSET)
    minute = F.hour(local) * 60 + F.minute(local)
    close = F.lit(None).cast("int")
    for day, sessions in hours.items():
        for begin, end in sessions:
            close = F.when((F.weekday(local) == day) & minute.between(begin, end - 1), end).otherwise(close)
    midnight = F.date_trunc("day", local)
    return F.to_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(midnight) + close * 60), LOCAL_OFFSET)


def run_window(day: Column) -> Column:
    """struct(first, last) of the dates a daily run fetches; nulls on Sundays."""
    weekday = F.weekday(day)
    first = F.when(weekday == 6, None).when(weekday == 0, day).otherwise(F.date_sub(day, 1))
    last = F.when(weekday == 6, None).when(weekday == 5, F.date_sub(day, 1)).otherwise(day)
    return F.struct(first.cast("date").alias("first"), last.cast("date").alias("last"))


def backoff_seconds(now: Column, recheck_minutes: int, hours: dict[int, list[tuple[int, int]]] = FRIDAY_HOURS) -> Column:
    """How long to wait after a halt was detected: no longer than to the close, at least a minute."""
    left = F.unix_timestamp(session_close(now, hours)) - F.unix_timestamp(now)
    return F.greatest(F.lit(60), F.least(F.lit(recheck_minutes * 60), F.coalesce(left, F.lit(recheck_minutes * 60))))
