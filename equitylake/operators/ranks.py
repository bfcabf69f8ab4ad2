"""Slices by rank and by page, and chunks.

Slices are limits: each task keeps its first rows and only those are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import staged


def ranked(stocks: DataFrame, by: str = "marketCap", key: str = "symbol") -> list[Column]:
    return [F.col(by).desc_nulls_last(), F.col(key).asc()]


def rank_slice(stocks: DataFrame, start: int = 1, end: int | None = None, by: str = "marketCap", key: str = "symbol") -> DataFrame:
    """Ranks start to end, from 1, both included; an end before the start counts as the start."""
    ordered = stocks.orderBy(*ranked(stocks, by, key))
    return ordered.offset(start - 1) if end is None else ordered.limit(max(end, start)).offset(start - 1)


def page_slice(stocks: DataFrame, page: int, size: int, by: str | None = "marketCap", key: str = "symbol", most: int = 25) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows, 1 to ``most``; alphabetical if ``by`` is None."""
    page, size = max(1, page), min(max(1, size), most)
    order = ranked(stocks, by, key) if by else [F.col(key).asc()]
    return stocks.orderBy(*order).limit(page * size).offset((page - 1) * size)


def numbered(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 0 in the order.

    The rows are dealt by ranges of the order, sorted within each, and written once with
    their partition and place: each exchange of its own draws its bounds from a sample, so
    that a second one would deal the rows otherwise. The sizes of the partitions before are
    then added, a row a partition. Rows that the order holds equal are told apart by a hash
    of their columns, so that ranges can part them."""
    at, part = "_at", "_part"
    kinds = dict(rows.dtypes)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if "map<" not in kinds[c] and kinds[c] != "variant"])
    full = [*order, tie]
    placed = staged(rows.repartitionByRange(*full).sortWithinPartitions(*full).withColumn(at, F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    before = sizes.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), part).withColumn(name, F.col(at) + F.col("_before")).drop(part, at, "_before")


def chunked(rows: DataFrame, size: int, order: list[Column]) -> DataFrame:
    """``rows`` with the number of their chunk."""
    return numbered(rows, order, "_rank").withColumn("chunk", F.floor(F.col("_rank") / size).cast("int")).drop("_rank")


def head_and_tail(rows: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first and the last ``n`` rows in the order, column ``part`` telling which."""
    first = rows.orderBy(*[F.col(c).asc() for c in order]).limit(n)
    last = rows.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return first.withColumn("part", F.lit("head")).unionByName(last.withColumn("part", F.lit("tail")))
