"""Queries over pages, feeds, reports and keyed tables made of the test tables: orders as
price rows and announcements, parts as companies, events as quotes. Keyed tables and
reports are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import calendars, filters, html, scalars
from .operators import corporate, coverage, gaps, history, instruments, intraday, ranks
from .plans import jobs
from .queries import _EVENTS, _GAPS, _RANGES, _hours_sql, _missing_spans, customers, event_rows, query, shipments, table
from .schemas import MARKET_WATCH, MISSING_REPORT
from .session import SETTINGS
from .sources import pages, readers
from .sources.tables import Table, record_failures, scratch_path, write_report

NOW = "2026-02-01 00:00:00"


def _cell(text: Column) -> Column:
    return F.concat(F.lit("<td>"), text, F.lit("</td>"))


def _history_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page a customer with a row for each order: a header, and a short row to be left out."""
    price = F.format_number("o_totalprice", 2)
    row = F.concat(F.lit("<tr>"), _cell(F.date_format("o_orderdate", "MMM d, yyyy")), *[_cell(price)] * 4, _cell(F.format_number("o_orderkey", 0)), F.lit("<td>more</td></tr>"))
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("symbol")).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    return rows.select("symbol", F.concat(F.lit("<table><tr><th>TIME</th></tr><tr><td>short</td></tr>"), "rows", F.lit("</table>")).alias("html"))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, p AS open, p AS high, p AS low, p AS close, CAST(o_orderkey AS DOUBLE) AS volume
  FROM (SELECT *, CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS p FROM orders)""")
def history_pages(spark, sf):
    return history.by_date(history.price_documents(history.preprocess(html.history_rows(_history_pages(spark, sf)))))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, round(o_totalprice, 2) AS close, CAST(o_orderkey AS DOUBLE) AS volume FROM orders
  WHERE year(o_orderdate) IN (1994, 1996) AND month(o_orderdate) >= 3""")
def fetched_months(spark, sf):
    """Pages of the months in which customers have orders, fetched as if from the network;
    the years and months asked for are pushed into the source."""
    orders = table(spark, sf, "orders")
    price = F.format_number("o_totalprice", 2)
    row = F.concat(F.lit("<tr>"), _cell(F.date_format("o_orderdate", "MMM d, yyyy")), *[_cell(price)] * 4, _cell(F.format_number("o_orderkey", 0)), F.lit("</tr>"))
    key = F.concat_ws("/", "o_custkey", F.year("o_orderdate"), F.month("o_orderdate"))
    held = orders.groupBy(key.alias("key")).agg(F.array_join(F.collect_list(row), "").alias("rows")).select("key", F.concat(F.lit("<table>"), "rows", F.lit("</table>")).alias("html"))
    where = pages.record_pages(held)
    day = F.to_date("o_orderdate")
    worklist = pages.months_to_fetch(orders.select(F.col("o_custkey").alias("symbol"), F.date_sub(day, 20).alias("start"), day.alias("end")))
    found = pages.fetched_pages(worklist, "equitylake.sources.pages:recorded_page", where).where(F.col("year").isin(1994, 1996) & (F.col("month") >= 3))
    return history.preprocess(html.history_rows(found)).select("symbol", "date", "close", "volume")


@query("""WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS close, CAST(o_orderkey AS DOUBLE) AS volume,
    CAST(o_orderdate AS DATE) <= DATE '1996-12-31' AS early, CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AS late FROM orders)
  SELECT symbol, date, arg_max(close, (close, volume)) AS close, max(CASE WHEN early THEN 1 ELSE 2 END) AS first_run, max(CASE WHEN late THEN 2 ELSE 1 END) AS last_run FROM o GROUP BY 1, 2""")
def ingested_history(spark, sf):
    """Two daily runs whose dates overlap: which of them made and which last wrote a row."""
    store = Table(spark, scratch_path(spark, "history"), "symbol string, date date, open bigint, high bigint, low bigint, close bigint, volume double, createdAt timestamp, updatedAt timestamp", ["symbol", "date"])
    found = _history_pages(spark, sf)
    jobs.daily_ingest(found, store, "1900-01-01", "1996-12-31", "2026-01-01")
    jobs.daily_ingest(found, store, "1996-01-01", "2100-01-01", "2026-01-02")
    return store.read().select("symbol", "date", "close", F.dayofmonth("createdAt").alias("first_run"), F.dayofmonth("updatedAt").alias("last_run"))


@query("""SELECT CAST(event_id AS VARCHAR) AS symbol, CAST(user_id AS VARCHAR) AS sector_code, ['A', 'B'] AS indices, value AS ldcp, value AS price,
    CASE WHEN event_id % 5 <> 0 THEN value END AS change_pct, CAST(event_id * 10 AS BIGINT) AS volume, 'Name ' || event_id AS name, CASE WHEN event_id % 2 = 0 THEN 'up' ELSE 'down' END AS change_direction
  FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""")
def market_watch_pages(spark, sf):
    return html.market_watch_rows(_watch_pages(spark, sf)).select("symbol", "sector_code", "indices", "ldcp", "price", "change_pct", "volume", "name", "change_direction")


def _watch_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page a user; every seventh row has nine cells, every eleventh no symbol."""
    number = lambda c: F.concat(F.lit('<td data-order="'), c.cast("string"), F.lit('">x</td>'))
    key, value = F.col("event_id").cast("string"), F.col("value")
    symbol = F.when(F.col("event_id") % 11 == 0, "").otherwise(key)
    cells = [
        F.concat(F.lit('<td data-order="'), symbol, F.lit('" data-title="Name '), key, F.lit('">'), symbol, F.lit("</td>")), _cell(F.col("user_id").cast("string")), F.lit("<td>A, ,B</td>"), *[number(value)] * 5,
        F.concat(F.lit('<td data-order="1"><div class="'), F.when(F.col("event_id") % 2 == 0, "change__text--positive").otherwise("change__text--flat"), F.lit('">1</div></td>')),
    ]
    more = F.concat(number(F.when(F.col("event_id") % 5 == 0, "bad").otherwise(value.cast("string"))), number(F.col("event_id") * 10))
    row = F.concat(F.lit("<tr>"), *cells, F.when(F.col("event_id") % 7 == 0, "").otherwise(more), F.lit("</tr>"))
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.collect_list(row), "").alias("html"), F.max("ts").alias("scraped_at"))


@query("""SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(event_id AS VARCHAR) ELSE '' END AS symbol, CASE WHEN event_id % 7 = 0 THEN 'cells' ELSE 'symbol' END AS reason,
    CASE WHEN event_id % 7 = 0 THEN 9 ELSE 11 END AS n_cells, CAST(user_id AS VARCHAR) AS sector_code FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""")
def market_watch_rejects(spark, sf):
    """The rows of the same pages that are no quotes, and why."""
    found = html.rejected_rows(html.market_watch_parsed(_watch_pages(spark, sf)))
    return found.select("symbol", "reason", F.size("texts").alias("n_cells"), F.col("texts")[1].alias("sector_code"))


@query("""WITH p AS (SELECT user_id, max(ts) AS scraped FROM events GROUP BY user_id), r AS (SELECT e.*, hour(scraped) < 12 AS early, event_id % 7 <> 0 AND event_id % 11 <> 0 AS good FROM events e JOIN p USING (user_id))
  SELECT CASE WHEN early THEN 1 ELSE 2 END AS cycle, count(*) FILTER (WHERE good) AS symbol_count, CAST(coalesce(sum(event_id * 10) FILTER (WHERE good), 0) AS BIGINT) AS total_volume, count(*) FILTER (WHERE NOT good) AS rejected,
    count(*) FILTER (WHERE good) AS inserted, CAST(0 AS BIGINT) AS updated FROM r GROUP BY early
  UNION ALL SELECT 3, count(*) FILTER (WHERE good), CAST(coalesce(sum(event_id * 10) FILTER (WHERE good), 0) AS BIGINT), count(*) FILTER (WHERE NOT good), 0, count(*) FILTER (WHERE good) FROM r WHERE NOT early""")
def cycle_counts(spark, sf):
    """What the job reports for the pages of the mornings, of the afternoons, and of those again."""
    store = Table(spark, scratch_path(spark, "counted"), MARKET_WATCH + ", scraped_at timestamp, scraped_at_minute timestamp, volume_delta bigint, day date", ["symbol", "scraped_at_minute"], ["day"])
    found = _watch_pages(spark, sf)
    early = F.hour("scraped_at") < 12
    counts = [(n, jobs.watch_pages(found.where(part), store)) for n, part in enumerate((early, ~early, ~early), 1)]
    names = ("symbol_count", "total_volume", "rejected", "inserted", "updated")
    return spark.createDataFrame([(n, *(c[k] for k in names)) for n, c in counts], "cycle int, " + ", ".join(f"{k} bigint" for k in names))


def _company_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of companies: two snapshots of every third part, a futures panel before the
    regular one, ranges as attributes or text; no quote section for every fourth part."""
    part = table(spark, sf, "part").repartition("p_partkey").withColumn("shot", F.explode(F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    money = lambda c: F.format_number(c, 2)
    price = F.col("p_retailprice")
    item = lambda label, value: F.concat(F.lit(f'<div class="stats_item"><div class="stats_label">{label}</div><div class="stats_value">'), value, F.lit("</div></div>"))
    marked = F.concat(F.lit('<div class="numRange" data-low="'), money(price - 5), F.lit('" data-high="'), money(price + 5), F.lit('"></div>'))
    shown = F.concat(money(price - 1), F.lit(" – "), money(price + 1))
    stats = [item("Open", money(price)), item("Volume", F.format_number(F.col("p_partkey") * 1000, 0)), item("Ask Price", F.lit("-")), item("LDCP", money(price - 2)), item("P/E Ratio (TTM) **", F.col("p_size").cast("string"))]
    held = F.concat(
        F.lit('<html><div class="company__quote"><div class="quote__name"> '), F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, "DELISTED").otherwise(""), F.lit('</div><div class="quote__sector">in <span>'), F.col("p_brand"),
        F.lit('</span></div><div class="quote__close">Rs.'), F.when(F.col("p_partkey") % 5 == 0, "").otherwise(money(price + F.col("shot"))), F.lit('</div><div class="quote__change '),
        F.when(F.col("p_partkey") % 2 == 0, "change__text--pos").otherwise("change__text--neg"), F.lit('"><div class="change__value">-1.25</div><div class="change__percent">(2.25%)</div></div><div class="quote__date">As of '),
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("p_partkey") % 300).cast("int")), "EEE, MMM d, yyyy"), F.lit(' 3:48 PM</div><div class="tabs__panel" data-name="FUT">'), item("Open", F.lit("9.99")),
        F.lit('</div><div class="tabs__panel" data-name="REG">'), *stats, F.lit('<div class="company__quote__rangeStats">'), item("CIRCUIT BREAKER", marked), item("DAY RANGE", shown), F.lit("</div></div></div></html>"),
    )
    page = F.when(F.col("p_partkey") % 4 == 0, "<html><p>no quote</p></html>").otherwise(held)
    at = F.timestamp_seconds(F.lit(1767225600) + F.col("shot") * 60)
    return part.select(F.concat(F.lit(" p"), F.col("p_partkey").cast("string")).alias("symbol"), page.alias("html"), at.alias("scraped_at"), F.concat(F.lit("x://"), F.col("p_partkey").cast("string")).alias("url"))


@query("""WITH s AS (SELECT p.*, k AS shot FROM part p, range(2) t(k) WHERE p_partkey % 4 <> 0 AND (k = 0 OR p_partkey % 3 = 0))
  SELECT 'P' || p_partkey AS symbol, p_name AS name, p_brand AS sector, CASE WHEN p_partkey % 5 <> 0 THEN round(p_retailprice + shot, 2) END AS price, CAST(-1.25 AS DOUBLE) AS change, CAST(2.25 AS DOUBLE) AS change_pct,
    CASE WHEN p_partkey % 2 = 0 THEN 'up' ELSE 'down' END AS change_direction, CAST(DATE '2026-01-01' + CAST(p_partkey % 300 AS INTEGER) AS TIMESTAMP) + INTERVAL 648 MINUTE AS as_of,
    round(p_retailprice, 2) AS open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low, CAST(p_partkey * 1000 AS BIGINT) AS volume, round(p_retailprice - 5, 2) AS circuit_breaker_low, round(p_retailprice + 5, 2) AS circuit_breaker_high,
    round(p_retailprice - 1, 2) AS day_range_low, round(p_retailprice + 1, 2) AS day_range_high, CAST(NULL AS DOUBLE) AS ask_price, CAST(NULL AS BIGINT) AS ask_volume, CAST(NULL AS DOUBLE) AS bid_price, CAST(NULL AS BIGINT) AS bid_volume,
    round(p_retailprice - 2, 2) AS ldcp, CAST(NULL AS DOUBLE) AS "var", CAST(NULL AS DOUBLE) AS haircut, CAST(p_size AS DOUBLE) AS pe_ratio_ttm, TIMESTAMP '2026-01-01 00:00:00' + shot * INTERVAL 1 MINUTE AS scraped_at, 'x://' || p_partkey AS source_url FROM s""")
def company_quotes(spark, sf):
    return html.company_quotes(_company_pages(spark, sf))


@query("""SELECT ' p' || p_partkey AS symbol, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 7 END AS n, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS VARCHAR) END AS pe
  FROM part p, range(2) t(k) WHERE k = 0 OR p_partkey % 3 = 0""")
def panel_stats(spark, sf):
    found = html.stats_maps(_company_pages(spark, sf))
    return found.select("symbol", F.size("stats").alias("n"), F.try_element_at("stats", F.lit("P/E Ratio (TTM) **")).alias("pe"))


@query(r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n_links FROM pages""")
def polled_titles(spark, sf):
    """Pages polled in a stream, stopped after its first batches and resumed."""
    rows = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("key"), "html")
    where = pages.record_pages(rows)
    worklist = table(spark, sf, "pages").select("page_id")
    n = worklist.count()
    path, out = pages.schedule(worklist, "page_id", max(1, n // 5)), scratch_path(spark, "polled")
    stream = pages.polled_pages(spark, path, "equitylake.sources.pages:recorded_page", where)

    def begin():
        return stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").start()

    first = begin()
    while first.isActive and (first.lastProgress is None or first.lastProgress["batchId"] < 1):
        first.awaitTermination(0.2)
    first.stop()
    again = begin()
    again.processAllAvailable()
    again.stop()
    found = spark.read.schema(stream.schema).parquet(f"{out}/rows").select(F.col("key").cast("bigint").alias("page_id"), "html")
    return html.page_titles(found)


@query(f"""WITH {_GAPS} SELECT CAST(symbol AS VARCHAR) AS symbol, start, "end", missing_trading_days, CAST(last_actual_date AS VARCHAR) AS last_actual_date FROM gaps""")
def gap_report(spark, sf):
    path = scratch_path(spark, "gap-report")
    write_report(gaps.price_gaps(shipments(spark, sf)), path, ["start", "end", "missing_trading_days", "last_actual_date"])
    return readers.gap_report(spark, path)


@query(f'WITH {_RANGES} SELECT CAST(symbol AS VARCHAR) AS symbol, start, "end" FROM ranges WHERE symbol % 3 <> 0')
def missing_report(spark, sf):
    """Written, read, and written again without what was done since."""
    path = scratch_path(spark, "missing-report")
    write_report(gaps.missing_ranges(_missing_spans(spark, sf), 10), path, ["start", "end"])
    found = readers.gap_report(spark, path, MISSING_REPORT)
    left = gaps.remaining(found, found.where("cast(symbol as int) % 3 = 0"), ["symbol", "start", "end"])
    write_report(left, path, ["start", "end"], keep_if_empty=False)
    return readers.gap_report(spark, path, MISSING_REPORT)


@query(f"""WITH {_GAPS} SELECT symbol, start, "end" FROM gaps WHERE symbol IN (SELECT symbol FROM gaps GROUP BY symbol ORDER BY symbol LIMIT 5)""")
def first_symbols(spark, sf):
    return gaps.first_symbols(gaps.price_gaps(shipments(spark, sf)), 5).select("symbol", "start", "end")


@query(f"""WITH {_GAPS} SELECT symbol, start, "end" FROM gaps WHERE symbol IN (SELECT symbol FROM gaps GROUP BY symbol ORDER BY min(start), symbol LIMIT 5)""")
def report_symbols(spark, sf):
    """The first symbols in a report's own order, here that of the gaps' starts."""
    report = gaps.price_gaps(shipments(spark, sf)).withColumn("pos", F.datediff("start", F.lit("1970-01-01").cast("date")))
    return gaps.first_symbols(report, 5, "pos").select("symbol", "start", "end")


def _repaired(spark: SparkSession, sf: str) -> tuple[Table, Table, DataFrame]:
    """Gaps of suppliers filled from orders of customers with the same keys; gaps of a
    multiple of seven days fail."""
    worklist = gaps.price_gaps(shipments(spark, sf)).select("symbol", "start", "end", "missing_trading_days")
    fetched = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("close"))
    store = Table(spark, scratch_path(spark, "repaired"), "symbol bigint, date date, close double, createdAt timestamp, updatedAt timestamp", ["symbol", "date"])
    failures = Table(spark, scratch_path(spark, "failures"), "symbol bigint, interval_start date, interval_end date, reason string, createdAt timestamp, updatedAt timestamp", ["symbol", "interval_start", "interval_end"])
    failed = worklist.where("missing_trading_days % 7 = 0").withColumn("reason", F.lit("timeout"))
    _, left = jobs.repair(worklist, fetched, failed, store, failures, NOW, ["start", "end"])
    return store, failures, left


@query(f"""WITH {_GAPS} SELECT DISTINCT symbol, date, max(o_totalprice) OVER (PARTITION BY symbol, date) AS close
  FROM (SELECT symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM gaps JOIN orders ON o_custkey = symbol AND CAST(o_orderdate AS DATE) BETWEEN start AND "end")""")
def repaired_history(spark, sf):
    return _repaired(spark, sf)[0].read().select("symbol", "date", "close")


@query(f"""WITH {_GAPS} SELECT symbol, start, "end", missing_trading_days FROM gaps g
  WHERE EXISTS (SELECT 1 FROM gaps f WHERE f.start = g.start AND f."end" = g."end" AND f.missing_trading_days % 7 = 0)""")
def repair_remaining(spark, sf):
    return _repaired(spark, sf)[2]


@query(f"""WITH {_GAPS} SELECT symbol, start AS interval_start, "end" AS interval_end, 'timeout' AS reason FROM gaps WHERE missing_trading_days % 7 = 0""")
def failed_intervals(spark, sf):
    failures = _repaired(spark, sf)[1]
    again = failures.read().select("symbol", "interval_start", "interval_end", F.lit("later").alias("reason"))
    record_failures(failures, again, "2026-03-01")
    return failures.read().select("symbol", "interval_start", "interval_end", "reason")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """(symbol, value): an answer a customer with a record for each order; some are broken."""
    k, text = F.col("o_orderkey"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    date = F.when(k % 13 == 0, "31 Feb 2026").otherwise(F.date_format("o_orderdate", "d MMM yyyy"))
    record = F.concat(
        F.lit('{"company_code":'), text(F.col("o_custkey").cast("string")), F.lit(',"bm_dividend":'), text(F.when(k % 3 == 0, "").otherwise(F.concat((k % 40).cast("string"), F.lit("%")))), F.lit(',"bm_bonus":'),
        F.when(k % 17 == 0, "null").when(k % 5 == 0, '"10%"').otherwise('""'), F.lit(',"bm_bc_exp":'), text(date), F.lit("}"),
    )
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("symbol")).agg(F.array_join(F.collect_list(record), ",").alias("r"))
    whole = F.concat(F.lit('{"d":['), "r", F.lit("]}"))
    return rows.select("symbol", F.when(F.col("symbol") % 10 == 0, "broken").when(F.col("symbol") % 10 == 1, F.concat(F.lit("["), "r", F.lit("]"))).otherwise(whole).alias("value"))


_PARSED = """p AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 40 AS DOUBLE) ELSE 0 END AS dividend, CASE WHEN o_orderkey % 5 = 0 THEN '10%' ELSE '' END AS bonus,
    CAST(o_orderdate AS DATE) AS x_date, (CASE WHEN o_orderkey % 3 <> 0 THEN ['dividend'] ELSE [] END) || (CASE WHEN o_orderkey % 5 = 0 THEN ['bonus'] ELSE [] END) AS kinds
  FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND (o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0) AND o_custkey % 10 <> 0)"""


@query(f"WITH {_PARSED} SELECT symbol, dividend, bonus, x_date, array_to_string(kinds, ',') AS kinds FROM p")
def announcements(spark, sf):
    found = corporate.parse_announcements(readers.announcement_records(_answers(spark, sf)))
    return found.select("symbol", "dividend", "bonus", "x_date", F.array_join("announcement_type", ",").alias("kinds"))


@query("""SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'null' WHEN o_orderkey % 13 = 0 THEN 'date' WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN 'kind' ELSE 'good' END AS outcome,
    CAST(o_custkey AS VARCHAR) AS symbol, count(*) AS n FROM orders WHERE o_custkey % 10 <> 0 GROUP BY ALL""")
def announcement_outcomes(spark, sf):
    """Every record once: good, or why not."""
    found = corporate.announcement_outcomes(readers.announcement_records(_answers(spark, sf)))
    return found.groupBy(F.coalesce("reason", F.lit("good")).alias("outcome"), "symbol").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS exDate, o_orderkey, CAST(o_orderkey % 7 + 1 AS DOUBLE) AS percent FROM orders)
  SELECT symbol, exDate, arg_min(percent, o_orderkey) / 10 AS amountPerShare FROM o GROUP BY symbol, exDate""")
def first_dividends(spark, sf):
    """Of a feed's dividends of one key the first in the feed's order is stored."""
    record = F.struct(F.col("o_custkey").cast("string").alias("company_code"), F.concat((F.col("o_orderkey") % 7 + 1).cast("string"), F.lit("%")).alias("bm_dividend"), F.date_format("o_orderdate", "d MMM yyyy").alias("bm_bc_exp"))
    feed = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", record.alias("r")))).alias("rs")).select(F.to_json("rs.r").alias("value"))
    parsed = corporate.parse_announcements(readers.announcement_records(feed, order=corporate.FEED_ORDER))
    dividends, bonuses = _paid_tables(spark)
    jobs.save_announcements(parsed, spark.createDataFrame([], "symbol string, faceValue double"), dividends, bonuses, "2100-01-01", NOW, "feed")
    return dividends.read().select("symbol", "exDate", "amountPerShare")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS code, CAST(o_custkey AS VARCHAR) AS scraped_symbol, '2026-02-01 00:00:00' AS scraped_at, count(*) AS n FROM orders WHERE o_custkey % 10 <> 0 GROUP BY o_custkey""")
def symbol_dividends(spark, sf):
    found = readers.symbol_dividends(_answers(spark, sf), NOW)
    keys = ("company_code", "_scraped_symbol", "_scraped_at")
    return found.groupBy(*[F.col("raw")[k].alias(a) for k, a in zip(keys, ("code", "scraped_symbol", "scraped_at"), strict=True)]).agg(F.count("*").alias("n"))


_SAVED = f"""WITH {_PARSED}, a AS (SELECT DISTINCT symbol, x_date, o_custkey % 2 = 0 AS even, o_custkey FROM p WHERE list_contains(kinds, 'dividend') AND dividend > 0),
  b AS (SELECT symbol, x_date, o_custkey FROM p WHERE list_contains(kinds, 'bonus'))"""


def _paid_tables(spark: SparkSession) -> tuple[Table, Table]:
    stamp = "status string, metadata struct<source:string,url:string,notes:string>, createdAt timestamp, updatedAt timestamp"
    dividends = Table(spark, scratch_path(spark, "dividends"), f"symbol string, exDate date, payDate date, faceValue double, amountPerShare double, {stamp}", ["symbol", "exDate"])
    return dividends, Table(spark, scratch_path(spark, "bonuses"), f"symbol string, exDate date, bonusPercentage double, bonusType string, {stamp}", ["symbol", "exDate"])


def _saved(spark: SparkSession, sf: str) -> tuple[Table, Table]:
    """Two rounds: customers of keys that 3 does not divide, then those that 2 does; dates
    from 1996 on are to come."""
    paid = corporate.parse_announcements(readers.announcement_records(_answers(spark, sf))).withColumn("dividend", F.when(F.col("dividend") > 0, 5.0).otherwise(0.0))
    dividends, bonuses = _paid_tables(spark)
    none = spark.createDataFrame([], "symbol string, faceValue double")
    for rows, now in ((paid.where("cast(symbol as int) % 3 <> 0"), "2026-01-01"), (paid.where("cast(symbol as int) % 2 = 0"), "2026-01-02")):
        jobs.save_announcements(rows, none, dividends, bonuses, "1996-01-01", now, "feed")
    return dividends, bonuses


@query(_SAVED + """ SELECT symbol, x_date AS exDate, CAST(0.5 AS DOUBLE) AS amountPerShare, CASE WHEN o_custkey % 3 <> 0 THEN 1 ELSE 2 END AS made
  FROM a WHERE even OR (o_custkey % 3 <> 0 AND x_date < DATE '1996-01-01')""")
def saved_dividends(spark, sf):
    return _saved(spark, sf)[0].read().select("symbol", "exDate", "amountPerShare", F.dayofmonth("createdAt").alias("made"))


@query(_SAVED + """ SELECT symbol, x_date AS exDate, made FROM b, (VALUES (1), (2)) v(made)
  WHERE (made = 1 AND o_custkey % 3 <> 0 AND (o_custkey % 2 = 0 OR x_date < DATE '1996-01-01')) OR (made = 2 AND o_custkey % 2 = 0)""")
def saved_bonuses(spark, sf):
    return _saved(spark, sf)[1].read().select("symbol", "exDate", F.dayofmonth("createdAt").alias("made"))


@query("""SELECT CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS pos, 'S' || p_partkey AS symbol, p_name AS name, p_type AS sectorName, p_size > 25 AS isETF,
  CASE WHEN p_partkey % 3 <> 0 THEN p_size = 1 END AS isDebt FROM part""")
def symbol_feed(spark, sf):
    """A feed a brand; every third instrument lacks a key."""
    bare = F.struct(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("symbol"), F.col("p_name").alias("name"), F.col("p_type").alias("sectorName"), (F.col("p_size") > 25).alias("isETF"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size") == 1).alias("isDebt"))
    texts = table(spark, sf, "part").groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct("p_partkey", bare.alias("r")))).alias("rs")).select(F.to_json("rs.r").alias("value"))
    return readers.feed_rows(texts)


@query("SELECT DISTINCT p_brand AS symbol FROM part")
def stored_symbols(spark, sf):
    return readers.stored_symbols(table(spark, sf, "part").select(F.col("p_brand").alias("symbol")))


@query("""SELECT 'N' || p_partkey AS symbol, 1 AS round FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'N' || p_partkey, 2 FROM part WHERE p_partkey % 2 <> 0 AND p_partkey % 3 = 0""")
def appended_symbols(spark, sf):
    """New symbols of two feeds, appended to the stored ones."""
    store, part = Table(spark, scratch_path(spark, "stocks"), "symbol string, round int", ["symbol"]), table(spark, sf, "part")
    for n, divisor in ((1, 2), (2, 3)):
        feed = part.where(F.col("p_partkey") % divisor == 0).select(F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("symbol"))
        store.append(instruments.new_symbols(feed, store.read()).withColumn("round", F.lit(n)))
    return store.read()


@query(f"""WITH {_EVENTS}, q AS (SELECT symbol, CASE WHEN seq % 4 <> 0 THEN date_trunc('day', ts) END AS as_of, ts, seq, volume FROM e)
  SELECT symbol, as_of, CAST(arg_max(coalesce(volume, -1), (ts, seq)) AS BIGINT) AS volume FROM q GROUP BY symbol, as_of""")
def quote_upserts(spark, sf):
    """Two cycles of quotes; those without an as_of share a row."""
    store = Table(spark, scratch_path(spark, "quotes"), "symbol bigint, as_of timestamp, seq bigint, volume bigint, scraped_at timestamp, createdAt timestamp, updatedAt timestamp", ["symbol", "as_of"])
    rows = table(spark, sf, "events").select(F.col("user_id").alias("symbol"), F.when(F.col("event_id") % 4 != 0, F.date_trunc("day", "ts")).alias("as_of"), F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 11 != 0, F.floor("value").cast("bigint")).otherwise(-1).alias("volume"), F.col("ts").alias("scraped_at"))
    cut = rows.agg(F.timestamp_seconds(F.avg(F.unix_timestamp("scraped_at"))).cast("string")).first()[0]
    for part in (F.col("scraped_at") <= F.lit(cut).cast("timestamp"), F.col("scraped_at") > F.lit(cut).cast("timestamp")):
        jobs.quote_cycle(rows.where(part), store, NOW)
    return store.read().select("symbol", "as_of", "volume")


@query(f"""WITH {_EVENTS}, b AS (SELECT symbol, date_trunc('minute', ts) AS bucket, volume FROM e QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, volume DESC NULLS LAST) = 1)
  SELECT symbol, bucket AS scraped_at_minute, volume, CASE WHEN CAST(bucket + INTERVAL 5 HOUR AS DATE) = CAST(lag(bucket) OVER w + INTERVAL 5 HOUR AS DATE)
    AND volume >= lag(volume) OVER w THEN volume - lag(volume) OVER w END AS volume_delta FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bucket)""")
def watch_cycles(spark, sf):
    """Cycles of the local mornings, then of the local afternoons, the last one twice."""
    store = Table(spark, scratch_path(spark, "watch"), "symbol bigint, scraped_at_minute timestamp, volume bigint, volume_delta bigint, scraped_at timestamp, day date", ["symbol", "scraped_at_minute"], ["day"])
    quotes = table(spark, sf, "events").select(F.col("user_id").alias("symbol"), F.col("ts").alias("scraped_at"), F.when(F.col("event_id") % 11 != 0, F.floor("value").cast("bigint")).alias("volume"))
    morning = F.hour(F.from_utc_timestamp("scraped_at", scalars.LOCAL_OFFSET)) < 12
    for part in (morning, ~morning, ~morning):
        jobs.watch_cycle(quotes.where(part), store)
    return store.read().select("symbol", "scraped_at_minute", "volume", "volume_delta")


@query("""SELECT o_orderkey AS rid, CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS exDate, round(CAST(o_orderkey % 20 AS DOUBLE) / 100 * CASE WHEN o_custkey % 2 = 0 THEN 5.0 ELSE 10.0 END, 4) AS amount
  FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 20 <> 0""")
def audited_records(spark, sf):
    """Texts like ``7(F)``; face values of active stocks only; every third customer is audited."""
    orders = table(spark, sf, "orders")
    raw = orders.select(F.col("o_orderkey").alias("rid"), F.col("o_custkey").cast("string").alias("symbol"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"), F.concat((F.col("o_orderkey") % 20).cast("string"), F.lit("(F)")).alias("dividend_text"))
    symbols = orders.select("o_custkey").distinct()
    stocks = symbols.select(F.col("o_custkey").cast("string").alias("symbol"), F.lit(5.0).alias("faceValue"), (F.col("o_custkey") % 2 == 0).alias("isActive"))
    return corporate.audit_records(raw, stocks, symbols.where("o_custkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("symbol")))


@query("SELECT c_custkey AS symbol FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def matching_symbols(spark, sf):
    stocks = table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"), "c_acctbal", "c_mktsegment")
    return filters.matching_symbols(stocks, {"c_acctbal": {"$gte": 0}, "c_mktsegment": {"$in": ["BUILDING", "MACHINERY"]}})


@query("""SELECT o_orderkey AS symbol FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' ORDER BY o_orderkey LIMIT 25 OFFSET 25""")
def new_symbols_batch(spark, sf):
    stocks = table(spark, sf, "orders").select(F.col("o_orderkey").alias("symbol"), F.col("o_orderdate").alias("createdAt"), "o_orderstatus")
    return jobs.new_symbols_batch(stocks, "1995-01-01", {"o_orderstatus": "F"}, 2, 40)


@query("""SELECT 'company_code' AS key, count(*) AS n, 0 AS n_null FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT 'bm_dividend', count(*), 0 FROM orders WHERE o_custkey % 10 <> 0
  UNION ALL SELECT 'bm_bonus', count(*), count(*) FILTER (WHERE o_orderkey % 17 = 0) FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT 'bm_bc_exp', count(*), 0 FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT 'sector_name', 0, 0""")
def json_profile(spark, sf):
    return readers.json_profile(readers.announcement_records(_answers(spark, sf)), ["COMPANY_CODE", "sector_name"]).select("key", "n", "n_null")


_PART_COLUMNS = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", '{t}' AS type, {k} AS pos, 6 AS n_columns, count(*) AS n, count(*) - count({c}) AS n_null, {f"CAST(min({c}) AS VARCHAR)" if t != "double" else "CAST(NULL AS VARCHAR)"} AS least,
  {f"CAST(max({c}) AS VARCHAR)" if t != "double" else "CAST(NULL AS VARCHAR)"} AS greatest FROM part""" for k, (c, t) in enumerate(_PART_COLUMNS.items())))
def inspect(spark, sf):
    """Every column; doubles' texts differ between engines and are left out."""
    found = coverage.inspect(table(spark, sf, "part"))
    return found.select("column", "type", "pos", "n_columns", "n", "n_null", *[F.when(F.col("type") != "double", F.col(c)).alias(c) for c in ("least", "greatest")])


@query("""(SELECT c_custkey AS symbol, 'head' AS part FROM customer ORDER BY c_custkey LIMIT 5) UNION ALL (SELECT c_custkey, 'tail' FROM customer ORDER BY c_custkey DESC LIMIT 5)""")
def head_and_tail(spark, sf):
    return ranks.head_and_tail(customers(spark, sf).select("symbol"), ["symbol"], 5)


@query("""SELECT min(o_custkey) AS form, CAST(count(*) AS INTEGER) AS n FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders WHERE o_custkey % 10 <> 0)""")
def working_form(spark, sf):
    return readers.working_form(_answers(spark, sf).withColumnRenamed("symbol", "form"))


@query("""WITH c AS (SELECT c_custkey AS page, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
  SELECT page, n FROM c WHERE page < coalesce((SELECT min(page) FROM c WHERE n = 0), 1000000000000)""")
def pages_read(spark, sf):
    counts = customers(spark, sf).join(table(spark, sf, "orders"), F.col("o_custkey") == F.col("symbol"), "left").groupBy(F.col("symbol").alias("page")).agg(F.count("o_orderkey").alias("n"))
    return readers.pages_read(counts)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, 2 * count(*) AS n FROM orders WHERE o_custkey % 10 <> 0 GROUP BY o_custkey""")
def audit_file(spark, sf):
    """Records appended to those of an earlier file, which is read back; none before the first."""
    path, found = scratch_path(spark, "audit"), readers.announcement_records(_answers(spark, sf))
    code = F.element_at("raw", "company_code")
    first = readers.audit_file(spark, path).unionByName(found)
    first.groupBy(code.alias("s")).agg(F.to_json(F.collect_list("raw")).alias("value")).select("value").repartition("value").write.text(path)
    return readers.audit_file(spark, path).unionByName(found).groupBy(code.alias("symbol")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, o_totalprice AS loose, o_orderkey AS whole, 'a-' || o_orderkey AS clean, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 648 MINUTE AS as_of, o_totalprice AS low, o_totalprice + 1 AS high, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS strict,
    'n' || o_orderkey AS name, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS iso, date_trunc('minute', o_orderdate + o_orderkey * INTERVAL 7 SECOND) AS minute, CAST(o_orderdate + o_orderkey * INTERVAL 7 HOUR + INTERVAL 5 HOUR AS DATE) AS day,
    CAST(o_orderkey % 30 AS DOUBLE) AS audit_percent, round(CAST(o_orderkey % 30 AS DOUBLE) / 100 * o_totalprice, 4) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 'up' ELSE 'down' END AS direction, CAST(o_orderkey % 50 AS INTEGER) AS duration FROM orders""")
def scraped_texts(spark, sf):
    rows, k, price = table(spark, sf, "orders"), F.col("o_orderkey"), F.format_number("o_totalprice", 2)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select(
        "o_orderkey", scalars.loose_double(F.concat(F.lit("(Rs "), price, F.lit("%)"))).alias("loose"), scalars.loose_int(F.format_number(k, 0)).alias("whole"), scalars.clean(F.concat(F.lit(" a\u00a0–"), k.cast("string"), F.lit(" "))).alias("clean"),
        scalars.as_of(F.concat(F.lit("As of Wed, "), F.date_format("o_orderdate", "MMM d, yyyy"), F.lit(" 3:48 PM"))).alias("as_of"), scalars.low_high(F.concat(price, F.lit(" – "), F.format_number(F.col("o_totalprice") + 1, 2)))["low"].alias("low"),
        scalars.low_high(F.concat(price, F.lit(" – "), F.format_number(F.col("o_totalprice") + 1, 2)))["high"].alias("high"), scalars.strict_double(F.when(k % 2 == 0, F.col("o_totalprice").cast("string")).otherwise("1,0")).alias("strict"),
        scalars.without_delisted(F.concat(F.lit("n"), k.cast("string"), F.lit("DELISTED"))).alias("name"), scalars.iso_date(F.when(k % 3 == 0, F.concat(day, F.lit(" or so"))).when(k % 3 == 1, F.concat(day, F.lit("T10:00:00Z"))).otherwise(day)).alias("iso"),
        scalars.minute_floor(F.col("o_orderdate") + F.make_dt_interval(secs=k * 7)).alias("minute"), scalars.local_date(F.col("o_orderdate") + F.make_dt_interval(hours=(k * 7).cast("int"))).alias("day"), scalars.audit_percentage(F.concat((k % 30).cast("string"), F.lit("% (F)"))).alias("audit_percent"),
        scalars.expected_amount((k % 30).cast("double"), F.col("o_totalprice")).alias("amount"), scalars.direction(F.when(k % 2 == 0, "a change__text--positive")).alias("direction"), scalars.duration(F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), (k % 50).cast("int"))).alias("duration"),
    )


@query("""WITH f(k, fmt) AS (VALUES (0, '%-d %b %Y'), (1, '%d-%b-%Y'), (2, '%-d/%-m/%Y'), (3, '%Y-%m-%d'), (4, '%B %-d, %Y'), (5, '%-d %B %Y'))
  SELECT o_orderkey, k AS format, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders, f""")
def date_formats(spark, sf):
    """Every order's date in each of the formats; every ninth with a letter behind."""
    shown = F.explode(F.array(*[F.struct(F.lit(k).alias("format"), F.date_format("o_orderdate", f).alias("text")) for k, f in enumerate(scalars.DATE_FORMATS)])).alias("s")
    rows = table(spark, sf, "orders").select("o_orderkey", shown)
    return rows.select("o_orderkey", "s.format", scalars.parse_date(F.concat("s.text", F.when(F.col("o_orderkey") % 9 == 0, "x").otherwise(""))).alias("day"))


_LOCAL = """l AS (SELECT event_id, ts, ts + INTERVAL 5 HOUR AS t FROM events),
  s AS (SELECT event_id, ts, t, (isodow(t) - 1) * 86400 + hour(t) * 3600 + minute(t) * 60 + CAST(floor(second(t)) AS BIGINT) AS s FROM l)"""


@query(f"""WITH {_LOCAL} SELECT event_id FROM s WHERE {_hours_sql(calendars.FRIDAY_HOURS)} = 0""")
def trading_rows(spark, sf):
    """Only what was scraped while the market was open."""
    from .streaming.intraday import during_trading

    return during_trading(table(spark, sf, "events"), "ts").select("event_id")


def _close_sql() -> str:
    cases = " ".join(f"WHEN s >= {d * 86400 + a * 60} AND s < {d * 86400 + b * 60} THEN {d * 86400 + b * 60}" for d, hours in calendars.FRIDAY_HOURS.items() for a, b in hours)
    return f"(CASE {cases} END)"


@query(f"""WITH {_LOCAL}, c AS (SELECT event_id, ts, s, {_close_sql()} AS c FROM s)
  SELECT event_id, date_trunc('second', ts) + (c - s) * INTERVAL 1 SECOND AS closes, CAST(greatest(60, least(1200, coalesce(c - s, 1200))) AS BIGINT) AS wait FROM c""")
def session_ends(spark, sf):
    """When an event's session closes, and how long to wait after a halt found at it."""
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", calendars.session_close(ts).alias("closes"), calendars.backoff_seconds(ts, 20).cast("bigint").alias("wait"))


def _drained(stream: DataFrame, out: str | None = None, **trigger: bool) -> DataFrame:
    """What a stream has written to ``out`` when its input ends; it goes on from where an
    earlier run there ended. State by processing time has always another batch to run: such
    a stream takes ``once=True``."""
    spark, key = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before, out = spark.conf.get(key, None), out or scratch_path(spark, "streamed")
    spark.conf.set(key, SETTINGS[key])
    try:
        stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(**(trigger or {"availableNow": True})).start().awaitTermination()
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


_SNAPSHOTS = "symbol string, scraped_at timestamp, volume bigint"
_DELTAS = f"""WITH {_EVENTS}, b AS (SELECT symbol, date_trunc('minute', ts) AS bucket, volume FROM e QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, seq DESC) = 1)
  SELECT symbol, bucket, volume, CASE WHEN CAST(bucket + INTERVAL 5 HOUR AS DATE) = CAST(lag(bucket) OVER w + INTERVAL 5 HOUR AS DATE)
    AND volume >= lag(volume) OVER w THEN volume - lag(volume) OVER w END AS volume_delta FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bucket)"""


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return intraday.latest_per_bucket(event_rows(spark, sf)).select(F.col("symbol").cast("string"), F.col("ts").alias("scraped_at"), "volume", "seq")


@query(_DELTAS)
def streamed_deltas(spark, sf):
    """The keyed state of the stream against the window of the batch: files hold some symbols
    each, whole, so that their order says nothing."""
    from .streaming.intraday import snapshots, volume_deltas

    path = scratch_path(spark, "snapshots")
    _snapshots(spark, sf).drop("seq").repartition("symbol").write.parquet(path)
    found = _drained(volume_deltas(snapshots(spark, path, _SNAPSHOTS), late="4000 days"))
    return found.withColumn("symbol", F.col("symbol").cast("bigint"))


@query(_DELTAS)
def streamed_with_ttl(spark, sf):
    """The same with minutes that live for 48 hours."""
    from .streaming.intraday import snapshots, volume_deltas

    path = scratch_path(spark, "snapshots")
    _snapshots(spark, sf).drop("seq").repartition("symbol").write.parquet(path)
    found = _drained(volume_deltas(snapshots(spark, path, _SNAPSHOTS, 100_000), ttl_hours=48), once=True)
    return found.withColumn("symbol", F.col("symbol").cast("bigint"))


def _delta_sql(rows: str) -> str:
    return f"""SELECT symbol, bucket, volume, CASE WHEN CAST(bucket + INTERVAL 5 HOUR AS DATE) = CAST(lag(bucket) OVER w + INTERVAL 5 HOUR AS DATE)
    AND volume >= lag(volume) OVER w THEN volume - lag(volume) OVER w END AS volume_delta FROM {rows} WINDOW w AS (PARTITION BY symbol ORDER BY bucket)"""


def _last_sql(which: str) -> str:
    return f"(SELECT symbol, date_trunc('minute', ts) AS bucket, volume FROM e WHERE {which} QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, seq DESC) = 1)"


@query(f"""WITH {_EVENTS}, b1 AS {_last_sql("seq % 3 <> 0")}, b2 AS {_last_sql("seq % 3 = 0")},
  m AS (SELECT * FROM b2 UNION ALL SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.symbol = b1.symbol AND b2.bucket = b1.bucket)),
  d1 AS ({_delta_sql("b1")}), dm AS ({_delta_sql("m")})
  SELECT dm.* FROM dm JOIN b2 ON b2.symbol = dm.symbol AND b2.bucket = dm.bucket
  UNION ALL SELECT d1.* FROM d1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.symbol = d1.symbol AND b2.bucket = d1.bucket)""")
def late_snapshots(spark, sf):
    """A third of the snapshots arrives after all others: they overwrite their minutes and get
    deltas of their own; deltas of later minutes stay."""
    from .streaming.intraday import snapshots, volume_deltas

    path, out = scratch_path(spark, "late"), scratch_path(spark, "streamed")
    rows = event_rows(spark, sf)
    for n, part in enumerate(("seq % 3 <> 0", "seq % 3 = 0")):
        last = intraday.latest_per_bucket(rows.where(part)).select(F.col("symbol").cast("string"), F.col("ts").alias("scraped_at"), "volume")
        last.repartition("symbol").write.mode("append").parquet(path)
        stream = volume_deltas(snapshots(spark, path, _SNAPSHOTS, 100_000), late="4000 days")
        found = _drained(stream.withColumn("run", F.lit(n)), out)
    others = F.struct("volume", "volume_delta")
    last = found.groupBy(F.col("symbol").cast("bigint").alias("symbol"), "bucket").agg(F.max_by(others, "run").alias("r"))
    return last.select("symbol", "bucket", "r.volume", "r.volume_delta")


_HALTS = """c AS (SELECT event_type AS market, date_trunc('hour', ts) AS cycle_ts, CAST(count(*) // 4 AS BIGINT) AS total FROM events GROUP BY 1, 2),
  f AS (SELECT *, CASE WHEN total = lag(total) OVER w THEN 0 ELSE 1 END AS chg, lead(cycle_ts) OVER w AS nxt FROM c WINDOW w AS (PARTITION BY market ORDER BY cycle_ts)),
  r AS (SELECT *, sum(chg) OVER (PARTITION BY market ORDER BY cycle_ts) AS run FROM f),
  runs AS (SELECT market, run, any_value(total) AS total, max(nxt) AS ends, list(cycle_ts ORDER BY cycle_ts) AS ats FROM r WHERE total <> 0 GROUP BY market, run),
  reports AS (
    SELECT market, run, total, ends, ats, ats[3] + INTERVAL 240 MINUTE AS reported FROM runs WHERE len(ats) >= 3
    UNION ALL SELECT market, run, total, ends, ats, list_filter(ats, lambda x: x > reported)[3] + INTERVAL 240 MINUTE FROM reports
      WHERE (ends IS NULL OR ends > reported) AND len(list_filter(ats, lambda x: x > reported)) >= 3)"""


@query(f"""WITH RECURSIVE {_HALTS} SELECT market, reported AS reported_at, total FROM reports WHERE (ends IS NULL OR ends > reported) AND reported <= (SELECT max(cycle_ts) FROM c)""")
def streamed_halts(spark, sf):
    """Cycles in files of any order, within the lateness; halts are reported by the clock of
    the stream, whether a cycle comes then or not."""
    from .streaming.intraday import halts

    hours = table(spark, sf, "events").groupBy(F.col("event_type").alias("market"), F.date_trunc("hour", "ts").alias("cycle_ts")).agg(F.floor(F.count("*") / 4).alias("total"))
    path, out = scratch_path(spark, "cycles"), scratch_path(spark, "streamed")
    schema, cycles = "market string, cycle_ts timestamp, total bigint", scratch_path(spark, "hours")
    hours.write.parquet(cycles)
    hours = spark.read.schema(schema).parquet(cycles)
    middle = hours.agg(F.timestamp_seconds(F.avg(F.unix_timestamp("cycle_ts"))).alias("t")).select(F.date_trunc("hour", "t").cast("string")).first()[0]
    for part in (F.col("cycle_ts") <= F.lit(middle).cast("timestamp"), F.col("cycle_ts") > F.lit(middle).cast("timestamp")):
        hours.where(part).repartition(4).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100_000).parquet(path)
        found = _drained(halts(stream, 3, 240), out)
    return found.where("halted").select("market", F.col("cycle_ts").alias("reported_at"), "total")
