"""The operators applied to the test tables, each with the SQL that says the same.

Roles: line items as price history (symbol = supplier, date = ship date), orders as daily
rows (symbol = customer) or announcements, events as snapshots (symbol = user)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import calendars, filters, html, scalars
from .operators import corporate, coverage, gaps, history, instruments, intraday, ranks, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

EXCLUSIONS = [("1995-01-16", "1995-01-16"), ("1995-02-20", "1995-02-22")]


def query(sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"), F.col("c_acctbal").alias("marketCap"))


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events")
    return rows.select(F.col("user_id").alias("symbol"), "ts", F.col("event_id").alias("seq"), F.when(F.col("event_id") % 11 != 0, F.floor("value").cast("bigint")).alias("volume"))


_HISTORY = "SELECT DISTINCT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date FROM lineitem"
_GAPS = f"""
  h AS ({_HISTORY}),
  cal AS (SELECT date, row_number() OVER (ORDER BY date) AS idx FROM (SELECT DISTINCT date FROM h)),
  n AS (SELECT symbol, date, idx, lead(idx) OVER (PARTITION BY symbol ORDER BY idx) AS nxt FROM h JOIN cal USING (date)),
  gaps AS (SELECT n.symbol, a.date AS start, b.date AS "end", CAST(n.nxt - n.idx - 1 AS INTEGER) AS missing_trading_days, n.date AS last_actual_date
           FROM n JOIN cal a ON a.idx = n.idx + 1 JOIN cal b ON b.idx = n.nxt - 1 WHERE n.nxt - n.idx > 1)"""


@query(f'WITH {_GAPS} SELECT symbol, start, "end", missing_trading_days, last_actual_date FROM gaps')
def price_gaps(spark, sf):
    return gaps.price_gaps(shipments(spark, sf))


@query(f"""WITH {_GAPS} SELECT symbol, start, "end", missing_trading_days, last_actual_date,
  CASE WHEN missing_trading_days < 7 THEN 'days' WHEN year(start) < 1994 THEN 'year' END AS skip_reason FROM gaps""")
def gap_eligibility(spark, sf):
    return gaps.gap_eligibility(gaps.price_gaps(shipments(spark, sf)), 7, 1994)


@query(f"""WITH {_GAPS} SELECT symbol FROM gaps GROUP BY symbol
  HAVING count(*) FILTER (WHERE missing_trading_days >= 40 AND year(start) >= 1994) = 0""")
def resolved_symbols(spark, sf):
    return gaps.resolved_symbols(gaps.price_gaps(shipments(spark, sf)), 40, 1994)


@query(f"SELECT date, CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS idx FROM (SELECT DISTINCT date FROM ({_HISTORY}))")
def master_calendar(spark, sf):
    return gaps.master_calendar(shipments(spark, sf))


_CALENDAR = f"""
  o AS ({_HISTORY}),
  cal AS (SELECT date FROM (SELECT CAST(unnest(generate_series((SELECT min(date) FROM o), (SELECT max(date) FROM o), INTERVAL 1 DAY)) AS DATE) AS date)
          WHERE isodow(date) <= 5 AND NOT date BETWEEN DATE '1995-01-16' AND DATE '1995-01-16' AND NOT date BETWEEN DATE '1995-02-20' AND DATE '1995-02-22'),
  miss AS (SELECT s.symbol, cal.date FROM (SELECT DISTINCT symbol FROM o) s CROSS JOIN cal
           WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.symbol = s.symbol AND o.date = cal.date))"""
_RANGES = f"""{_CALENDAR},
  flags AS (SELECT symbol, date, CASE WHEN date - lag(date) OVER (PARTITION BY symbol ORDER BY date) > 3 THEN 1 ELSE 0 END AS f FROM miss),
  grp AS (SELECT symbol, date, sum(f) OVER (PARTITION BY symbol ORDER BY date) AS g FROM flags),
  spans AS (SELECT symbol, min(date) AS start, max(date) AS "end" FROM grp GROUP BY symbol, g),
  ranges AS (SELECT symbol, start, "end" FROM spans
    WHERE ("end" - start) + 1 - 2 * ((("end" - start) + (isodow(start) - 1)) // 7) > 10)"""


def _missing(spark, sf):
    days = shipments(spark, sf)
    return gaps.missing_dates(days, calendars.calendar_of(days, EXCLUSIONS), days)


def _missing_spans(spark, sf):
    days = shipments(spark, sf)
    return gaps.missing_spans(days, calendars.calendar_of(days, EXCLUSIONS), days)


@query(f"WITH {_CALENDAR} SELECT symbol, date FROM miss")
def missing_business_days(spark, sf):
    return _missing(spark, sf)


@query(f'WITH {_RANGES} SELECT symbol, start, "end" FROM ranges')
def missing_ranges(spark, sf):
    return gaps.missing_ranges(_missing_spans(spark, sf), 10)


@query(f"""WITH {_RANGES} SELECT start, "end", count(*) AS n_symbols, 0 AS part, string_agg(CAST(symbol AS VARCHAR), ',' ORDER BY CAST(symbol AS VARCHAR)) AS symbols
  FROM ranges GROUP BY start, "end" HAVING count(*) > 1""")
def range_to_symbols(spark, sf):
    return gaps.ranges_to_symbols(gaps.missing_ranges(_missing_spans(spark, sf), 10), 1)


@query(f"""WITH {_RANGES} SELECT symbol, start, "end" FROM ranges WHERE symbol % 3 <> 0""")
def worklist_remaining(spark, sf):
    ranges = gaps.missing_ranges(_missing_spans(spark, sf), 10)
    return gaps.remaining(ranges, ranges.where("symbol % 3 = 0"), ["symbol", "start", "end"])


_CLOSED = """
  x AS (SELECT o_custkey % 3 AS market, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS "end" FROM orders WHERE o_orderkey % 50 = 1),
  d AS (SELECT DISTINCT l_suppkey % 3 AS market, CAST(l_shipdate AS DATE) AS date FROM lineitem)"""


def _closed(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").where("o_orderkey % 50 = 1").select((F.col("o_custkey") % 3).alias("market"), day.alias("start"), F.date_add(day, (F.col("o_orderkey") % 40).cast("int")).alias("end"))


@query(f"""WITH {_CLOSED} SELECT market, date FROM d WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.market = d.market AND d.date BETWEEN x.start AND x."end")""")
def open_days(spark, sf):
    """Days outside the ranges, overlapping ones among them, that a table holds for each market."""
    days = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 3).alias("market"), F.to_date("l_shipdate").alias("date")).distinct()
    return calendars.outside(days, _closed(spark, sf), ["market"])


@query(f"""WITH {_CLOSED}, days AS (SELECT DISTINCT market, CAST(unnest(generate_series(start, "end", INTERVAL 1 DAY)) AS DATE) AS day FROM x),
  runs AS (SELECT market, day, date_trunc('month', day) AS month, day - CAST(row_number() OVER (PARTITION BY market, date_trunc('month', day) ORDER BY day) AS INTEGER) AS g FROM days)
  SELECT market, CAST(month AS DATE) AS month, min(day) AS start, max(day) AS "end" FROM runs GROUP BY market, month, g""")
def merged_closures(spark, sf):
    return calendars.merged_ranges(_closed(spark, sf), ["market"])


_COVERAGE = """
  a AS (SELECT o_custkey AS symbol, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-01' - 40 AND DATE '1995-06-10' + 40 GROUP BY 1),
  c AS (SELECT c_custkey AS symbol, coalesce(n, 0) AS n, first, last,
        coalesce(first <= DATE '1995-06-01' AND last >= DATE '1995-06-10' AND n >= 5, false) AS has_coverage FROM customer LEFT JOIN a ON symbol = c_custkey)"""


def _coverage(spark, sf):
    return coverage.coverage(customers(spark, sf), order_days(spark, sf), "1995-06-01", "1995-06-10", 40)


@query(f"WITH {_COVERAGE} SELECT symbol, n, first, last, has_coverage FROM c")
def history_coverage(spark, sf):
    return _coverage(spark, sf)


@query(f"""WITH {_COVERAGE} SELECT count(*) AS processed, count(*) FILTER (WHERE has_coverage) AS skipped,
  CAST(count(*) FILTER (WHERE has_coverage) AS DOUBLE) / count(*) * 100 AS skip_rate FROM c""")
def skip_rate(spark, sf):
    return coverage.skip_rate(_coverage(spark, sf))


@query("SELECT c_custkey AS symbol, c_acctbal AS marketCap FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 50 OFFSET 10")
def rank_slice(spark, sf):
    return ranks.rank_slice(customers(spark, sf), 11, 60)


@query("SELECT c_custkey AS symbol, c_acctbal AS marketCap FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 50")
def page_slice(spark, sf):
    return ranks.page_slice(customers(spark, sf), 3, 40, by=None)


@query("SELECT c_custkey AS symbol, CAST((row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) - 1) // 20 AS INTEGER) AS chunk FROM customer")
def chunked(spark, sf):
    rows = customers(spark, sf)
    return ranks.chunked(rows, 20, ranks.ranked(rows)).select("symbol", "chunk")


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS price FROM lineitem")
def price_to_minor_units(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalars.minor_units(F.col("l_extendedprice")).alias("price"))


@query("""SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS open, max(o_totalprice) AS high,
  min(o_totalprice) AS low, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS close, CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2""")
def ohlcv_normalise(spark, sf):
    orders = table(spark, sf, "orders")
    return history.daily_bars(orders.select(F.col("o_custkey").alias("symbol"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price")))


@query("""SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders
  WHERE o_custkey IN (1, 2, 3, 5, 8, 13) AND CAST(o_orderdate AS DATE) BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""")
def stocks_slice(spark, sf):
    return history.stocks(order_days_priced(spark, sf), [1, 2, 3, 5, 8, 13], "1994-01-01", "1996-12-31")


def order_days_priced(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price"))


def _keyed_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("""SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, t.o_orderstatus,
  s.o_orderkey IS NOT NULL AND t.o_orderkey IS NULL AS _inserted, s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL AS _updated
  FROM (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) t
  FULL JOIN (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 3 <> 1) s ON s.o_orderkey = t.o_orderkey""")
def history_upsert(spark, sf):
    rows = _keyed_orders(spark, sf)
    source = rows.where("o_orderkey % 3 <> 1").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return store.upsert(rows.where("o_orderkey % 3 <> 0"), source, ["o_orderkey"])


@query("""WITH t AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS exDate, o_totalprice AS amount, o_orderkey AS id FROM orders),
  old AS (SELECT symbol, exDate, amount, id FROM t WHERE id % 2 = 0),
  new AS (SELECT symbol, exDate, amount, id FROM t WHERE id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY symbol, exDate ORDER BY id) = 1)
  SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.symbol = new.symbol AND old.exDate = new.exDate)""")
def insert_ignore(spark, sf):
    rows = _announced(spark, sf).select("symbol", "exDate", "amount", "id")
    return store.insert_ignore(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"), ["symbol", "exDate"], F.col("id"))


def _announced(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("exDate"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source"))


@query("""WITH t AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS exDate, o_totalprice AS amount, o_orderkey AS id, o_orderpriority AS source FROM orders)
  SELECT id, symbol, exDate FROM t WHERE NOT (exDate >= DATE '1996-01-01' AND source = '1-URGENT')
  OR EXISTS (SELECT 1 FROM t i WHERE i.id % 5 = 0 AND i.symbol = t.symbol AND i.exDate = t.exDate)""")
def orphan_delete(spark, sf):
    rows = _announced(spark, sf)
    return store.delete_orphans(rows, rows.where("id % 5 = 0"), ["symbol", "exDate"], "1996-01-01", "1-URGENT", F.col("source")).select("id", "symbol", "exDate")


@query("""WITH t AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS exDate FROM orders) SELECT symbol, exDate, count(*) AS "count" FROM t GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_keys(spark, sf):
    return store.repeated_keys(_announced(spark, sf), ["symbol", "exDate"])


@query("""SELECT symbol FROM (SELECT p_partkey AS symbol FROM part WHERE p_size > 5 AND NOT contains(lower(p_type), 'promo'))
  WHERE symbol NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)""")
def new_symbols(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("symbol"), "p_size", "p_type")
    held = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("symbol"))
    return instruments.new_symbols(part.where(~F.lower("p_type").contains("promo") & (F.col("p_size") > 5)).select("symbol"), held)


@query("""WITH f AS (SELECT p_brand AS symbol, p_partkey AS pos, CASE WHEN p_partkey % 7 = 0 THEN '()' WHEN p_partkey % 11 = 0 THEN p_name || ' (R)' ELSE p_name END AS name, p_size = 1 AS isDebt FROM part)
  SELECT symbol, arg_max(name, pos) AS name, arg_max(isDebt, pos) AS isDebt FROM f WHERE NOT isDebt AND name <> '()' AND NOT contains(lower(name), '(r)') GROUP BY symbol""")
def tradable_instruments(spark, sf):
    name = F.when(F.col("p_partkey") % 7 == 0, "()").when(F.col("p_partkey") % 11 == 0, F.concat("p_name", F.lit(" (R)"))).otherwise(F.col("p_name"))
    feed = table(spark, sf, "part").select(F.col("p_brand").alias("symbol"), F.col("p_partkey").alias("pos"), name.alias("name"), (F.col("p_size") == 1).alias("isDebt"))
    return instruments.tradable(feed)


def _paid(spark, sf):
    items = table(spark, sf, "lineitem")
    kind = F.array(F.when(F.col("l_returnflag") == "A", "dividend").when(F.col("l_returnflag") == "N", "bonus").otherwise("right"))
    return items.select(F.col("l_partkey").alias("symbol"), scalars.percentage(F.concat((F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))).alias("dividend"),
                        F.concat(F.col("l_linenumber").cast("string"), F.lit("%")).alias("bonus"), F.to_date("l_shipdate").alias("x_date"), kind.alias("announcement_type"))


@query("""SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS exDate, CAST(l_shipdate AS DATE) AS payDate, coalesce(fv, 10.0) AS faceValue,
  CAST(CAST(trunc(l_discount * 100) AS INTEGER) AS DOUBLE) * coalesce(fv, 10.0) / 100 AS amountPerShare
  FROM lineitem LEFT JOIN (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS fv FROM part) ON p_partkey = l_partkey
  WHERE l_returnflag = 'A' AND CAST(trunc(l_discount * 100) AS INTEGER) > 0""")
def dividend_amounts(spark, sf):
    stocks = table(spark, sf, "part").select(F.col("p_partkey").alias("symbol"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")).alias("faceValue"))
    return corporate.dividends(_paid(spark, sf), stocks)


@query("""SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS exDate, CAST(l_linenumber AS DOUBLE) AS bonusPercentage, 'BONUS_SHARES' AS bonusType
  FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber > 0""")
def bonus_rows(spark, sf):
    return corporate.bonuses(_paid(spark, sf))


@query("""SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'A') AS n_dividend, count(*) FILTER (WHERE l_returnflag = 'N') AS n_bonus,
  count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS n_right, CAST(min(l_shipdate) AS DATE) AS first_date, CAST(max(l_shipdate) AS DATE) AS last_date,
  CAST(min(CAST(trunc(l_discount * 100) AS INTEGER)) AS DOUBLE) AS min_dividend, CAST(max(CAST(trunc(l_discount * 100) AS INTEGER)) AS DOUBLE) AS max_dividend FROM lineitem""")
def announcement_breakdown(spark, sf):
    return corporate.breakdown(_paid(spark, sf))


@query("""SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS n_dividends, CAST(min(o_orderdate) AS DATE) AS earliest, CAST(max(o_orderdate) AS DATE) AS latest,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_bonuses FROM orders WHERE o_orderstatus = 'O'""")
def collection_stats(spark, sf):
    orders = table(spark, sf, "orders").withColumn("exDate", F.to_date("o_orderdate"))
    return corporate.collection_stats(orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus = 'F'"))


_AUDIT = """
  r AS (SELECT o_orderkey AS rid, o_custkey AS symbol, CAST(o_orderdate AS DATE) AS exDate, o_totalprice AS amount FROM orders WHERE o_orderkey % 2 = 0),
  s AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS db_date, o_totalprice AS db_amount FROM orders WHERE o_orderkey % 2 = 1),
  m AS (SELECT r.*, db_date, db_amount, CAST(abs(db_date - exDate) AS INTEGER) AS date_diff FROM r LEFT JOIN s ON s.symbol = r.symbol AND abs(db_date - exDate) <= 30
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY abs(db_date - exDate), db_date, db_amount) = 1),
  a AS (SELECT rid, symbol, exDate, amount, db_date, db_amount, date_diff, abs(amount - db_amount) AS amount_diff,
        CASE WHEN db_date IS NULL THEN 'missing' WHEN abs(amount - db_amount) >= 50000 THEN 'discrepancy' ELSE 'ok' END AS status FROM m)"""


def _audit(spark, sf):
    rows = _announced(spark, sf)
    records = rows.where("id % 2 = 0").select(F.col("id").alias("rid"), "symbol", "exDate", "amount")
    return corporate.audit(records, rows.where("id % 2 = 1").select("symbol", "exDate", "amount"), 30, 50000.0)


@query(f"WITH {_AUDIT} SELECT * FROM a")
def dividend_audit(spark, sf):
    return _audit(spark, sf)


@query(f"""WITH {_AUDIT} SELECT count(*) AS processed_records, count(DISTINCT symbol) AS audited_stocks_count, count(*) FILTER (WHERE status = 'missing') AS missing_in_db_count,
  count(*) FILTER (WHERE status = 'discrepancy') AS discrepancies_count, (SELECT count(*) FROM orders) AS total_json_records, (SELECT count(*) FROM orders) - count(*) AS skipped_records,
  30 AS date_tolerance_days, CAST(50000 AS DOUBLE) AS amount_tolerance FROM a""")
def audit_summary(spark, sf):
    return corporate.audit_summary(_audit(spark, sf), table(spark, sf, "orders"), 30, 50000.0)


_EVENTS = "e AS (SELECT user_id AS symbol, ts, event_id AS seq, CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value) AS BIGINT) END AS volume FROM events)"
_BUCKETS = f"""{_EVENTS}, b AS (SELECT symbol, date_trunc('hour', ts) AS bucket, volume FROM e
  QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', ts) ORDER BY ts DESC, seq DESC) = 1)"""


@query(f"WITH {_EVENTS} SELECT symbol, ts, seq, volume FROM e QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) = 1")
def latest_snapshot(spark, sf):
    return intraday.latest_snapshot(event_rows(spark, sf))


def _buckets(spark, sf):
    return intraday.latest_per_bucket(event_rows(spark, sf), "hour").select("symbol", "bucket", "volume")


@query(f"""WITH {_BUCKETS} SELECT symbol, bucket, volume, CASE WHEN CAST(bucket + INTERVAL 5 HOUR AS DATE) = CAST(lag(bucket) OVER w + INTERVAL 5 HOUR AS DATE)
  AND volume >= lag(volume) OVER w THEN volume - lag(volume) OVER w END AS volume_delta FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bucket)""")
def volume_delta(spark, sf):
    return intraday.volume_delta(_buckets(spark, sf))


@query(f"WITH {_BUCKETS} SELECT bucket, CAST(sum(coalesce(volume, 0)) AS BIGINT) AS total_volume FROM b GROUP BY bucket")
def total_volume(spark, sf):
    return intraday.total_volume(_buckets(spark, sf))


@query("""WITH c AS (SELECT date_trunc('hour', ts) AS cycle_ts, CAST(count(*) // 8 AS BIGINT) AS total FROM events GROUP BY 1),
  f AS (SELECT *, CASE WHEN total = lag(total) OVER (ORDER BY cycle_ts) THEN 0 ELSE 1 END AS chg FROM c),
  r AS (SELECT *, sum(chg) OVER (ORDER BY cycle_ts) AS run FROM f),
  t AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY cycle_ts) AS n FROM r),
  s AS (SELECT *, min(CASE WHEN n = 3 THEN cycle_ts END) OVER (PARTITION BY run ORDER BY cycle_ts) AS run_start FROM t)
  SELECT cycle_ts, total, run_start, coalesce(total <> 0 AND n >= 3 AND date_diff('second', run_start, cycle_ts) >= 7200, false) AS stale FROM s""")
def stasis(spark, sf):
    hours = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("cycle_ts")).agg(F.floor(F.count("*") / 8).alias("total"))
    return intraday.stasis(hours, 3, 120)


def _hours_sql(hours: dict[int, list[tuple[int, int]]]) -> str:
    """Seconds to the next opening by the nearest session that has not ended, over eight days."""
    sessions = [(d * 86400 + a * 60, d * 86400 + b * 60) for d, s in hours.items() for a, b in s]
    sessions += [(a + 604800, b + 604800) for a, b in sessions]
    rows = ", ".join(f"({a}, {b})" for a, b in sessions)
    return f"""(SELECT min(greatest(0, a - s)) FROM (VALUES {rows}) v(a, b) WHERE b > s)"""


@query(f"""WITH l AS (SELECT event_id, ts + INTERVAL 5 HOUR AS t FROM events),
  s AS (SELECT event_id, (isodow(t) - 1) * 86400 + hour(t) * 3600 + minute(t) * 60 + CAST(floor(second(t)) AS BIGINT) AS s FROM l)
  SELECT event_id, CAST({_hours_sql(calendars.SIMPLE_HOURS)} AS INTEGER) AS simple_wait, CAST({_hours_sql(calendars.FRIDAY_HOURS)} AS INTEGER) AS friday_wait FROM s""")
def market_clock(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", calendars.seconds_until_open(ts, calendars.SIMPLE_HOURS).alias("simple_wait"), calendars.seconds_until_open(ts).alias("friday_wait"))


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
  SELECT day, CASE isodow(day) WHEN 7 THEN NULL WHEN 1 THEN day ELSE day - 1 END AS first, CASE isodow(day) WHEN 7 THEN NULL WHEN 6 THEN day - 1 ELSE day END AS last FROM d""")
def run_window(spark, sf):
    days = order_days(spark, sf).select(F.col("date").alias("day")).distinct()
    return days.select("day", calendars.run_window(F.col("day")).alias("w")).select("day", "w.first", "w.last")


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR")
def retention(spark, sf):
    rows = table(spark, sf, "events")
    last = rows.agg(F.max("ts").alias("_last"))  # one row
    return store.retained(rows.join(F.broadcast(last)), "ts", F.col("_last")).select("event_id")


PREDICATE = {"$and": [{"$or": [{"o_orderstatus": "F"}, {"o_totalprice": {"$gte": 150000, "$lt": 250000}}]}, {"o_orderdate": {"$gte": "1994-01-01", "$lt": "1997-06-01T12:00:00.000Z"}}, {"o_orderpriority": {"$nin": ["5-LOW"], "$regex": "^[1-3]"}}, {"o_custkey": {"$not": {"$in": [1, 2, 3]}}}]}


@query("""SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR (o_totalprice >= 150000 AND o_totalprice < 250000)) AND o_orderdate >= TIMESTAMP '1994-01-01 00:00:00'
  AND o_orderdate < TIMESTAMP '1997-06-01 12:00:00' AND o_orderpriority <> '5-LOW' AND regexp_matches(o_orderpriority, '^[1-3]') AND o_custkey NOT IN (1, 2, 3)""")
def json_predicate(spark, sf):
    return table(spark, sf, "orders").where(filters.compile_filter(PREDICATE)).select("o_orderkey")


@query(r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n_links FROM pages""")
def page_meta(spark, sf):
    return html.page_titles(table(spark, sf, "pages"))


@query("""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + to_months(CAST(k AS INTEGER)) AS DATE) AS month FROM orders, range(3) t(k)""")
def month_list(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", F.explode(calendars.month_starts(day, F.add_months(F.trunc(day, "month"), 2))).alias("month"))


@query("""SELECT o_orderkey, CAST((SELECT count(*) FROM range(11) t(k) WHERE isodow(CAST(o_orderdate AS DATE) + CAST(k AS INTEGER)) <= 5) AS INTEGER) AS n FROM orders""")
def business_day_count(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", calendars.business_days(day, F.date_add(day, 10)).alias("n"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) AS d2, round(10 / 100.0 * CAST(o_totalprice AS DOUBLE), 4) AS amount FROM orders""")
def text_functions(spark, sf):
    rows = table(spark, sf, "orders")
    shown = lambda f: scalars.parse_date(F.date_format("o_orderdate", f))
    return rows.select("o_orderkey", shown("d MMM yyyy").alias("d1"), shown("dd-MMM-yyyy").alias("d2"), scalars.expected_amount(scalars.percentage(F.lit("10%")), F.col("o_totalprice")).alias("amount"))
