"""Which symbols already have a range of history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(symbols: DataFrame, history: DataFrame, start: str, end: str, tolerance_days: int = 5) -> DataFrame:
    """(symbol, n, first, last, has_coverage): rows within the range and the margins;
    covered if they reach both ends and number at least half the range's days."""
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    least = max(1, int(((b - a).days + 1) * 0.5))
    margin = dt.timedelta(days=tolerance_days)
    near = history.where(F.col("date").between(F.lit(a - margin), F.lit(b + margin)))
    counts = near.groupBy("symbol").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    joined = symbols.select("symbol").distinct().join(counts, "symbol", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    covered = (F.col("first") <= F.lit(a)) & (F.col("last") >= F.lit(b)) & (F.col("n") >= least)
    return joined.withColumn("has_coverage", F.coalesce(covered, F.lit(False)))


def skip_rate(covered: DataFrame) -> DataFrame:
    """One row: processed, skipped, skip_rate in percent."""
    sums = covered.agg(F.count("*").alias("processed"), F.count_if("has_coverage").alias("skipped"))
    return sums.withColumn("skip_rate", F.when(F.col("processed") > 0, F.col("skipped") / F.col("processed") * 100).otherwise(0.0))


def inspect(frame: DataFrame) -> DataFrame:
    """(column, type, pos, n_columns, n, n_null, least, greatest) of a frame, a row a column in
    the order of ``pos``, in one pass: the frame's shape and what its columns hold."""
    parts = []
    for pos, (name, kind) in enumerate(frame.dtypes):
        plain = F.col(f"`{name}`")
        ends = (F.min(plain), F.max(plain)) if not kind.startswith(("map", "array", "struct")) else (F.lit(None), F.lit(None))
        shape = (F.lit(name).alias("column"), F.lit(kind).alias("type"), F.lit(pos).alias("pos"), F.lit(len(frame.columns)).alias("n_columns"))
        parts.append(F.struct(*shape, F.count("*").alias("n"), F.count_if(plain.isNull()).alias("n_null"), ends[0].cast("string").alias("least"), ends[1].cast("string").alias("greatest")))
    return frame.agg(F.array(*parts).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")
