"""The jobs, composed of the operators. No connection and no clock in here: tables, dates
and feeds are passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import filters
from ..functions.html import good_rows, history_rows, market_watch_parsed
from ..operators import corporate, coverage, gaps, history, instruments, intraday, ranks, store
from ..sources.tables import Table, record_failures, staged


def daily_ingest(pages: DataFrame, table: Table, start: str, end: str, now: str) -> tuple[int, int]:
    """Fetched pages (symbol, html) into the price history: (inserted, updated)."""
    series = history.preprocess(history_rows(pages)).where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return table.upsert(history.price_documents(series), now)


def symbols_to_fetch(stocks: DataFrame, price_history: DataFrame, start: str, end: str, rank_from: int = 1, rank_to: int | None = None, chunk: int = 10) -> DataFrame:
    """(symbol, chunk) of the ranks that do not have the range yet."""
    chosen = ranks.rank_slice(stocks, rank_from, rank_to)
    bare = coverage.coverage(chosen, price_history, start, end).where("not has_coverage").select("symbol")
    return ranks.chunked(bare, chunk, [F.col("symbol")])


def repair_worklist(price_history: DataFrame, min_days: int = 7, min_year: int = 2010) -> DataFrame:
    return gaps.gap_eligibility(gaps.price_gaps(price_history), min_days, min_year).where("skip_reason is null").drop("skip_reason")


def save_announcements(parsed: DataFrame, stocks: DataFrame, dividend_table: Table, bonus_table: Table, today: str, now: str, source: str) -> None:
    """Orphans go, new dividends come in (existing ones stay as they are; of a batch's dividends of
    one key the first in the feed's order), bonuses are appended."""
    stamp = {"metadata": F.struct(F.lit(source).alias("source"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("notes")), "status": F.lit("ANNOUNCED"), "createdAt": F.lit(now).cast("timestamp"), "updatedAt": F.lit(now).cast("timestamp")}
    for table, rows in ((dividend_table, corporate.dividends(parsed, stocks)), (bonus_table, corporate.bonuses(parsed))):
        rows = rows.withColumns(stamp)
        held = table.read()
        if not parsed.isEmpty():
            held = store.delete_orphans(held, rows, ["symbol", "exDate"], today, source, F.col("metadata.source"))
        if table is dividend_table:
            table.replace(store.insert_ignore(held, rows, ["symbol", "exDate"], F.col(corporate.FEED_ORDER) if corporate.FEED_ORDER in rows.columns else None))
        else:
            table.replace(store.append(held, rows))


def sync_symbols(feed: DataFrame, stocks: DataFrame) -> DataFrame:
    return instruments.new_symbols(instruments.tradable(feed), stocks)


def dividend_audit(raw: DataFrame, stocks: DataFrame, stored: DataFrame, tolerance_days: int = 0, amount_tolerance: float = 0.0, audited: DataFrame | None = None) -> DataFrame:
    return corporate.audit(corporate.audit_records(raw, stocks, audited), stored, tolerance_days, amount_tolerance)


def repair(worklist: DataFrame, fetched: DataFrame, failed: DataFrame, table: Table, failures: Table, now: str, unit: list[str]) -> tuple[tuple[int, int], DataFrame]:
    """One round over a report's rows (symbol, start, end, ...): the fetched rows (symbol,
    date, ...) that lie in them are upserted, failed ones (symbol, start, end, reason) are
    recorded, and what remains is returned with the counts. A ``unit`` with a failure
    remains whole: ``["symbol"]``, ``["start", "end"]`` or all three. A range without rows is done."""
    spans = worklist.select("symbol", "start", "end").distinct()
    inside = fetched.join(spans, "symbol").where(F.col("date").between(F.col("start"), F.col("end"))).select(*fetched.columns)
    counts = table.upsert(inside, now)
    record_failures(failures, failed.select("symbol", F.col("start").alias("interval_start"), F.col("end").alias("interval_end"), "reason"), now)
    return counts, worklist.join(failed.select(*unit).distinct(), unit, "left_semi")


def new_symbols_batch(stocks: DataFrame, created: str | None, query: dict | None, batch: int, size: int) -> DataFrame:
    """The batch of the symbols that were created at or after a day and fit a predicate; one
    of both is needed."""
    if not created and not query:
        raise ValueError("a day or a predicate is needed")
    wanted = filters.created_after(created, query) if created else query
    return ranks.page_slice(filters.matching_symbols(stocks, wanted), batch, size, by=None)


def watch_cycle(quotes: DataFrame, table: Table) -> dict:
    """A cycle's quotes (MARKET_WATCH and scraped_at) into the table keyed by symbol and
    minute; a repeated cycle changes nothing. Returns its counts."""
    return watch_parsed(quotes.withColumn("reason", F.lit(None).cast("string")).withColumn("texts", F.lit(None).cast("array<string>")), table)


def watch_pages(pages: DataFrame, table: Table) -> dict:
    """Market-watch pages (html, scraped_at), parsed once, into the table; counts as those of
    ``watch_cycle``."""
    return watch_parsed(market_watch_parsed(pages), table)


def watch_parsed(parsed: DataFrame, table: Table) -> dict:
    """Counts and sums are observed while the rows are written for the cycle's other steps."""
    seen = Observation()
    good = F.col("reason").isNull()
    sums = [F.count_if(good).alias("symbol_count"), F.sum(F.when(good, F.coalesce("volume", F.lit(0)))).alias("total_volume"), F.count_if(~good).alias("rejected"), F.max(F.when(good, F.col("scraped_at"))).cast("string").alias("now"), F.min(F.when(good, F.col("scraped_at"))).cast("string").alias("first")]
    quotes = good_rows(staged(parsed.observe(seen, *sums), "cycle"))
    found = seen.get
    counts = {"symbol_count": found["symbol_count"], "total_volume": found["total_volume"] or 0, "inserted": 0, "updated": 0, "rejected": found["rejected"]}
    if not counts["symbol_count"]:
        return counts
    stored = table.read()
    if "day" in table.partition_by:  # a local day lies in two of them
        first = (dt.date.fromisoformat(found["first"][:10]) - dt.timedelta(days=1)).isoformat()
        stored = table.read(partitions=lambda values: (values[table.partition_by.index("day")] or first) >= first)
    rows = intraday.cycle_rows(stored.select("symbol", "scraped_at_minute", "volume"), quotes)
    if "day" in table.partition_by:
        rows = rows.withColumn("day", F.to_date("scraped_at_minute"))
    counts["inserted"], counts["updated"] = table.upsert(rows, found["now"])
    return counts


def quote_cycle(quotes: DataFrame, table: Table, now: str) -> tuple[int, int]:
    """Company quotes into the table keyed by symbol and as_of; those without an as_of share
    one row a symbol, the last scraped."""
    return table.upsert(quotes, now, F.col("scraped_at"))
