"""Missing dates and price gaps of all symbols at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendars import business_days

NEAR = 3  # days from a missing date to the next of the same range
MOST_LISTED = 10_000


def master_calendar(history: DataFrame) -> DataFrame:
    """(date, idx): the distinct dates seen, numbered. One row a date, so that one task
    numbers them."""
    dates = history.select("date").where("date is not null").distinct()
    return dates.withColumn("idx", F.row_number().over(Window.orderBy("date")))


def price_gaps(history: DataFrame) -> DataFrame:
    """(symbol, start, end, missing_trading_days, last_actual_date): runs of calendar dates
    that a symbol lacks between two dates that it has.

    Only present rows are shuffled: a gap is what lies between a symbol's neighbours on the
    numbered calendar. The calendar (a row a date) joins by its size's choice."""
    calendar = master_calendar(history)
    held = history.select("symbol", "date").where("symbol is not null").distinct().join(calendar, "date")
    after = F.lead("idx").over(Window.partitionBy("symbol").orderBy("idx"))
    open_ = held.withColumn("after", after).where(F.col("after") - F.col("idx") > 1)
    first = calendar.select((F.col("idx") - 1).alias("idx"), F.col("date").alias("start"))
    final = calendar.select((F.col("idx") + 1).alias("after"), F.col("date").alias("end"))
    found = open_.join(first, "idx").join(final, "after")
    return found.select("symbol", "start", "end", (F.col("after") - F.col("idx") - 1).alias("missing_trading_days"), F.col("date").alias("last_actual_date"))


def numbered_calendar(calendar: DataFrame) -> DataFrame:
    """(date, idx, block): the calendar's dates numbered from 1; a new block begins where more
    than ``NEAR`` days lie between two of them. One row a date, so that one task numbers them."""
    by_date = Window.orderBy("date")
    apart = F.coalesce(F.datediff("date", F.lag("date").over(by_date)) > NEAR, F.lit(False)).cast("int")
    days = calendar.select("date").where("date is not null").distinct().withColumn("_apart", apart)
    return days.select("date", F.row_number().over(by_date).alias("idx"), F.sum("_apart").over(by_date).alias("block"))


def missing_stretches(symbols: DataFrame, days: DataFrame, history: DataFrame) -> DataFrame:
    """(symbol, first, last): places on the numbered calendar between which a symbol has no
    date at all: what lies between neighbours among its dates, 0 and the calendar's end. Only
    dates that are there are shuffled, and a row a symbol."""
    wanted = symbols.select("symbol").where("symbol is not null").distinct()
    held = history.select("symbol", "date").join(days.select("date", "idx"), "date").select("symbol", "idx").distinct()
    marks = held.join(wanted, "symbol", "left_semi").unionByName(wanted.select("symbol", F.lit(0).alias("idx")))
    size = days.select(F.coalesce(F.max("idx"), F.lit(0))).scalar()
    after = F.coalesce(F.lead("idx").over(Window.partitionBy("symbol").orderBy("idx")), size + 1)
    return marks.select("symbol", (F.col("idx") + 1).alias("first"), (after - 1).alias("last")).where("first <= last")


def missing_spans(symbols: DataFrame, calendar: DataFrame, history: DataFrame) -> DataFrame:
    """(symbol, start, end): runs of neighbouring calendar dates, at most ``NEAR`` days from
    one to the next, that a symbol lacks. A row a run, never a row a date."""
    days = numbered_calendar(calendar)
    found = missing_stretches(symbols, days, history)
    first = days.select(F.col("idx").alias("first"), F.col("date").alias("start"), F.col("block").alias("_from"))
    last = days.select(F.col("idx").alias("last"), F.col("date").alias("end"), F.col("block").alias("_to"))
    dated = found.join(first, "first").join(last, "last")
    # Where the calendar itself has a hole a run is cut in two.
    cut = dated.select("symbol", "start", "end", F.explode(F.sequence("_from", "_to")).alias("block"))
    blocks = days.groupBy("block").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    return cut.join(blocks, "block").select("symbol", F.greatest("start", "_first").alias("start"), F.least("end", "_last").alias("end"))


def missing_dates(symbols: DataFrame, calendar: DataFrame, history: DataFrame) -> DataFrame:
    """(symbol, date): calendar dates that a symbol lacks, a row each: the result's own size."""
    days = numbered_calendar(calendar)
    places = missing_stretches(symbols, days, history).select("symbol", F.explode(F.sequence("first", "last")).alias("idx"))
    return places.join(days.select("idx", "date"), "idx").select("symbol", "date")


def missing_ranges(missing: DataFrame, threshold: int = 1) -> DataFrame:
    """(symbol, start, end): missing spans (symbol, start, end), or dates (symbol, date), no
    more than three days apart make one range; kept if it has more than ``threshold``
    business days."""
    spans = missing if "start" in missing.columns else missing.select("symbol", F.col("date").alias("start"), F.col("date").alias("end"))
    by_start = Window.partitionBy("symbol").orderBy("start")
    parted = spans.withColumn("new", (F.datediff("start", F.lag("end").over(by_start)) > NEAR).cast("int"))
    grouped = parted.withColumn("grp", F.sum(F.coalesce("new", F.lit(0))).over(by_start))
    joined = grouped.groupBy("symbol", "grp").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.where(business_days(F.col("start"), F.col("end")) > threshold).select("symbol", "start", "end")


def gap_eligibility(gaps: DataFrame, min_days: int = 7, min_year: int = 2010) -> DataFrame:
    """``gaps`` with skip_reason, null where a gap is to be fetched; days are tested first."""
    reason = F.when(F.col("missing_trading_days") < min_days, "days").when(F.year("start") < min_year, "year")
    return gaps.withColumn("skip_reason", reason)


def resolved_symbols(gaps: DataFrame, min_days: int = 7, min_year: int = 2010) -> DataFrame:
    """(symbol) without an eligible gap."""
    judged = gap_eligibility(gaps, min_days, min_year)
    return judged.groupBy("symbol").agg(F.count_if(F.col("skip_reason").isNull()).alias("n")).where("n = 0").select("symbol")


def ranges_to_symbols(ranges: DataFrame, more_than: int = 2, most_listed: int = MOST_LISTED) -> DataFrame:
    """(start, end, n_symbols, part, symbols): ranges that more than so many symbols lack,
    longest first. A range's symbols are listed in order, ``most_listed`` to a row at most;
    ``part`` numbers its rows from 0."""
    symbol = F.col("symbol").cast("string")
    counts = ranges.groupBy("start", "end").agg(F.count("*").alias("n_symbols")).where(F.col("n_symbols") > more_than)
    wanted = ranges.join(counts, ["start", "end"]).select("start", "end", "n_symbols", symbol.alias("symbol"))
    place = F.row_number().over(Window.partitionBy("start", "end").orderBy("symbol")) - 1
    parts = wanted.withColumn("part", F.floor(place / most_listed).cast("int"))
    listed = parts.groupBy("start", "end", "n_symbols", "part").agg(F.array_join(F.sort_array(F.collect_list("symbol")), ",").alias("symbols"))
    return listed.orderBy(F.desc(F.datediff("end", "start")), "start", "symbols")


def first_symbols(report: DataFrame, limit: int, ordinal: str | None = None) -> DataFrame:
    """Rows of a report (symbol, ...) of its first ``limit`` symbols, all for 0 or less: in the
    report's order by column ``ordinal``, where a symbol first stands; else in the symbols' own."""
    if limit <= 0:
        return report
    places = report.groupBy("symbol").agg(F.min(ordinal or "symbol").alias("_place"))
    # At most ``limit`` symbols.
    return report.join(places.orderBy("_place", "symbol").limit(limit).select("symbol"), "symbol", "left_semi")


def remaining(worklist: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The worklist without what was done."""
    return worklist.join(done.select(*keys).distinct(), keys, "left_anti")
