"""The instrument list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tradable(feed: DataFrame, order: str = "pos") -> DataFrame:
    """The feed without debt and without rights, blank or ``()`` names; of rows with the
    same symbol, the last by ``order``."""
    name = F.trim(F.coalesce("name", F.lit("")))
    kept = feed.where(~F.coalesce("isDebt", F.lit(False)) & (name != "") & ~F.lower(name).contains("(r)") & (name != "()"))
    columns = [c for c in feed.columns if c not in ("symbol", order)]
    last = kept.groupBy("symbol").agg(F.max_by(F.struct(*columns), order).alias("_last"))
    return last.select("symbol", "_last.*")


def new_symbols(feed: DataFrame, stocks: DataFrame) -> DataFrame:
    """Symbols of the feed that are not stored, in order."""
    return feed.join(stocks.select("symbol"), "symbol", "left_anti").orderBy("symbol")
