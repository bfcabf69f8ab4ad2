"""Keyed writes as DataFrame -> DataFrame; ``sources.tables`` puts the results in place."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(rows: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """The last row of each key by ``order``, of equal ones (or without an order) that of
    greatest values."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    values = F.struct(*others)
    return rows.groupBy(*keys).agg(F.max_by(values, values if order is None else F.struct(order, values)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], now: str | None = None) -> DataFrame:
    """``target`` with each row of ``source`` (one a key) put over the row of its key, nulls
    included; columns that the source lacks keep their values. Keys compare null-safely.
    ``createdAt`` is kept, and set to ``now`` for new rows; ``updatedAt`` is set to ``now``.
    Columns ``_inserted`` and ``_updated`` tell what happened to a row."""
    t, s = target.alias("t"), source.withColumn("_in_source", F.lit(True)).alias("s")
    held = t.withColumn("_in_target", F.lit(True)).alias("t")
    match = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = held.join(s, on=match[0] if len(match) == 1 else [*match], how="full")
    new, old = F.coalesce(F.col("s._in_source"), F.lit(False)), F.coalesce(F.col("t._in_target"), F.lit(False))
    stamp = F.lit(now).cast("timestamp")
    out = []
    for name in target.columns:
        if name == "createdAt" and now:
            value = F.when(old, F.col("t.createdAt")).otherwise(stamp)
        elif name == "updatedAt" and now:
            value = F.when(new, stamp).otherwise(F.col("t.updatedAt"))
        elif name in source.columns:
            value = F.when(new, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.col(f"t.{name}")
        out.append(value.alias(name))
    return joined.select(*out, (new & ~old).alias("_inserted"), (new & old).alias("_updated"))


def write_counts(upserted: DataFrame) -> DataFrame:
    return upserted.agg(F.count_if("_inserted").alias("inserted"), F.count_if("_updated").alias("updated"))


def same_keys(keys: list[str]) -> Column:
    """Whether rows of frames aliased ``a`` and ``b`` have the same keys, nulls included."""
    equal = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    return functools.reduce(Column.__and__, equal)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """``target`` and the source rows of new keys, the first of each key by ``order``, of equal
    ones (or without an order) that of least values. Keys compare null-safely."""
    others = [c for c in source.columns if c not in keys]
    values = F.struct(*others) if others else F.lit(0)
    least = source.groupBy(*keys).agg(F.min_by(values, values if order is None else F.struct(order, values)).alias("_r"))
    first = least.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*source.columns)
    new = first.alias("a").join(target.select(*keys).alias("b"), same_keys(keys), "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def delete_orphans(target: DataFrame, incoming: DataFrame, keys: list[str], today: str, source_name: str, source_column: Column, date: str = "exDate") -> DataFrame:
    """``target`` without the rows of ``source_name`` from ``today`` on that ``incoming`` lacks;
    keys compare null-safely. Callers skip it for an empty feed."""
    doomed = (F.col(date) >= F.lit(dt.date.fromisoformat(today))) & (source_column == source_name)
    marked = target.withColumn("_doomed", F.coalesce(doomed, F.lit(False)))
    there = incoming.select(*keys).distinct().withColumn("_there", F.lit(True))
    joined = marked.alias("a").join(there.alias("b"), same_keys(keys), "left")
    return joined.where("not _doomed or _there").select(*[F.col(f"a.`{c}`").alias(c) for c in target.columns])


def append(target: DataFrame, source: DataFrame, dedupe_on: list[str] | None = None) -> DataFrame:
    """Both, as they are; without repeated keys if asked."""
    both = target.unionByName(source, allowMissingColumns=True)
    return both.dropDuplicates(dedupe_on) if dedupe_on else both


def retained(rows: DataFrame, ts: str, now: str | Column, hours: int = 48) -> DataFrame:
    at = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    return rows.where(F.col(ts) >= at - F.expr(f"interval {hours} hours"))


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a unique index would refuse."""
    return rows.groupBy(*keys).count().where("count > 1")
