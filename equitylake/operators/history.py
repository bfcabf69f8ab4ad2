"""Daily price history: typing, conversion, slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.tables import staged

PRICES = ("open", "high", "low", "close")


def preprocess(raw: DataFrame) -> DataFrame:
    """(symbol, date, open ... volume as double) of OHLCV_RAW text; commas go, bad text raises."""
    number = lambda c: F.regexp_replace(F.col(c), ",", "").cast("double")
    columns = {c: number(c.upper()) for c in (*PRICES, "volume")}
    return raw.select("symbol", F.to_date(F.try_to_timestamp("TIME", F.lit("MMM d, yyyy"))).alias("date"), *[v.alias(k) for k, v in columns.items()])


def by_date(series: DataFrame) -> DataFrame:
    """In the order of dates, symbols within a date: a range partitioning, no single task. Its
    bounds are drawn by a run of their own, so the rows are written once before."""
    return staged(series, "series").orderBy("date", "symbol")


def price_documents(series: DataFrame) -> DataFrame:
    """Prices in hundredths."""
    return series.withColumns({c: S.minor_units(F.col(c)) for c in PRICES})


def stocks(history: DataFrame, symbols: list[str], start: str, end: str) -> DataFrame:
    """Rows of the symbols from start to end, both included; no symbols, no rows."""
    return history.where(F.col("symbol").isin(symbols) & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def daily_bars(trades: DataFrame) -> DataFrame:
    """(symbol, date, open, high, low, close, volume) of trades (symbol, ts, seq, price):
    first and last by (ts, seq)."""
    at = F.struct("ts", "seq")
    return trades.groupBy("symbol", F.to_date("ts").alias("date")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").cast("double").alias("volume")
    )
