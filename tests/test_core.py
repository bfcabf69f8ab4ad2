"""Operators that the tables do not exercise, on small rows with expected results by hand."""

import datetime as dt
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from equitylake import schemas
from equitylake.functions import calendars, filters, html, scalars
from equitylake.operators import corporate, coverage, gaps, history, instruments, intraday, ranks, store
from equitylake.sources import pages, readers, tables
from equitylake.streaming import intraday as streaming

D = dt.date


def one(spark, value, f):
    return spark.range(1).select(f(F.lit(value))).first()[0]


@pytest.mark.parametrize("text,want", [("20 Apr 2026", D(2026, 4, 20)), ("19-Mar-2026", D(2026, 3, 19)), ("2026-03-19", D(2026, 3, 19)), ("20  Apr 2026", D(2026, 4, 20)), ("31 Feb 2026", None), ("March 9, 2026", D(2026, 3, 9)), ("9/3/2026", D(2026, 3, 9)), ("", None)])
def test_parse_date(spark, text, want):
    assert one(spark, text, scalars.parse_date) == want


@pytest.mark.parametrize("f,text,want", [(scalars.percentage, "10(F)", 0.0), (scalars.audit_percentage, "10(F)", 10.0), (scalars.percentage, "2160%", 2160.0), (scalars.loose_double, "(2.25%)", 2.25), (scalars.loose_int, "1,234.5", 12345), (scalars.loose_int, "-", None), (scalars.clean, " a b – c", "ab - c")])
def test_text(spark, f, text, want):
    assert one(spark, text, f) == want


@pytest.mark.parametrize("price,want", [(100.125, 10012), (12.345, 1234), (2.675, 268), (1.005, 100)])
def test_minor_units(spark, price, want):
    assert one(spark, price, scalars.minor_units) == want == int(round(price * 100))


def test_as_of_and_ranges(spark):
    row = spark.range(1).select(scalars.as_of(F.lit("As of Wed, Jun 24, 2026 3:48 PM")).cast("string").alias("t"), scalars.low_high(F.lit("411.72 – 503.22")).alias("r"), scalars.low_high(F.lit("x")).alias("n")).first()
    assert row["t"] == "2026-06-24 10:48:00" and tuple(row["r"]) == (411.72, 503.22) and tuple(row["n"]) == (None, None)


@pytest.mark.parametrize("local,wait", [("2026-06-22 09:24:00", 60), ("2026-06-22 09:25:00", 0), ("2026-06-22 15:54:59", 0), ("2026-06-22 15:55:00", 63000), ("2026-06-26 12:00:00", 0), ("2026-06-26 12:01:00", 8940), ("2026-06-26 14:30:00", 0), ("2026-06-26 16:55:00", 232200), ("2026-06-27 09:25:00", 172800)])
def test_clock(spark, local, wait):
    assert one(spark, local, lambda c: calendars.seconds_until_open(F.to_utc_timestamp(c, "+05:00"))) == wait


def test_history_html(spark):
    cell = lambda *v: "<tr>" + "".join(f"<td>{x}</td>" for x in v) + "</tr>"
    page = "<table><tr><th>TIME</th></tr>" + cell("Dec 10, 2018", "1,234.50", "1,240.00", "1,230.00", "100.125", "1,234,567") + cell("Dec 11, 2018", "12.345", "13", "12", "2.675", "0", "extra") + cell("a", "b", "c", "d", "e") + "</table>"
    frame = spark.createDataFrame([("A", page), ("B", None), ("C", "<table></table>")], "symbol string, html string")
    rows = history.price_documents(history.preprocess(html.history_rows(frame))).orderBy("date").collect()
    assert [(r["date"], r["open"], r["close"], r["volume"]) for r in rows] == [(D(2018, 12, 10), 123450, 10012, 1234567.0), (D(2018, 12, 11), 1234, 268, 0.0)]


def test_market_watch_html(spark):
    def row(symbol, css, n=11):
        cells = [f"<td data-order='{symbol}' data-title='Name'>{symbol}</td>", "<td>801</td>", "<td>A, ,B</td>"] + [f"<td data-order='{k}.5'>x</td>" for k in range(5)] + [f"<td data-order='1'><div class='{css}'>1</div></td>", "<td data-order='bad'>x</td>", "<td data-order='70'>70</td>"]
        return "<tr>" + "".join(cells[:n]) + "</tr>"

    frame = spark.createDataFrame([(row("S", "change__text--positive") + row("T", "flat") + row("U", "", 9) + row("", ""), dt.datetime(2026, 1, 1))], "html string, scraped_at timestamp")
    rows = html.market_watch_rows(frame).orderBy("symbol").collect()
    assert [(r["symbol"], r["change_direction"], r["indices"], r["volume"], r["change_pct"], r["ldcp"]) for r in rows] == [("S", "up", ["A", "B"], 70, None, 0.5), ("T", "down", ["A", "B"], 70, None, 0.5)]


def test_announcements(spark):
    text = '{"d":[{"company_code":"MEBL","bm_dividend":"2160%","bm_bonus":"10%","bm_right_per":"","bm_bc_exp":"19-Mar-2026"},{"company_code":"AAA","bm_dividend":"10(F)","bm_bc_exp":"2026-03-19"},{"company_code":"BBB","bm_right_per":"15%","bm_bc_exp":"09 Mar 2026"},{"company_code":"CCC","bm_bc_exp":"09 Mar 2026"},{"company_code":"EEE","bm_dividend":"5%","bm_bonus":null,"bm_bc_exp":"09 Mar 2026"},{"company_code":"GGG","bm_dividend":"-5%","bm_bc_exp":"20  Apr 2026"}]}'
    parsed = corporate.parse_announcements(readers.announcement_records(spark.createDataFrame([(text,), ("broken",)], "value string")))
    kinds = {r["symbol"]: r["announcement_type"] for r in parsed.collect()}
    assert kinds == {"MEBL": ["dividend", "bonus"], "AAA": ["dividend"], "BBB": ["right"], "GGG": ["dividend"]}
    stocks = spark.createDataFrame([("MEBL", 5.0)], "symbol string, faceValue double")
    assert [(r["symbol"], r["amountPerShare"]) for r in corporate.dividends(parsed, stocks).collect()] == [("MEBL", 108.0)]
    assert [(r["symbol"], r["bonusPercentage"]) for r in corporate.bonuses(parsed).collect()] == [("MEBL", 10.0)]


def test_instruments(spark):
    rows = [(0, "AKB", "Bank", True), (1, "AAA", "Old", False), (2, "AAA", "Alpha", False), (3, "BBB", "Beta(R)", False), (4, "CCC", "()", False), (5, "DDD", " ", False), (6, "EEE", "Eps", None)]
    found = instruments.tradable(spark.createDataFrame(rows, "pos int, symbol string, name string, isDebt boolean"))
    assert {(r["symbol"], r["name"]) for r in found.collect()} == {("AAA", "Alpha"), ("EEE", "Eps")}


def test_gap_islands(spark):
    days = [D(2026, 1, k) for k in range(1, 9)]
    rows = [("CAL", d) for d in days] + [("X", days[k]) for k in (1, 2, 5, 7)]
    found = gaps.price_gaps(spark.createDataFrame(rows, "symbol string, date date")).orderBy("start").collect()
    assert [tuple(r) for r in found] == [("X", days[3], days[4], 2, days[2]), ("X", days[6], days[6], 1, days[5])]


def test_missing_ranges(spark):
    rows = [("A", D(2026, 1, 5)), ("A", D(2026, 1, 7)), ("B", D(2026, 1, 9)), ("B", D(2026, 1, 12)), ("C", D(2026, 1, 8)), ("C", D(2026, 1, 12))]
    found = gaps.missing_ranges(spark.createDataFrame(rows, "symbol string, date date"), 1).collect()
    assert {tuple(r) for r in found} == {("A", D(2026, 1, 5), D(2026, 1, 7)), ("B", D(2026, 1, 9), D(2026, 1, 12))}


def test_coverage(spark):
    rows = [("A", D(2026, 1, k)) for k in (3, 6, 8, 10, 15)] + [("B", D(2026, 1, k)) for k in (3, 6, 10, 15)] + [("C", D(2026, 1, k)) for k in (6, 7, 8, 9, 15)]
    symbols = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    found = coverage.coverage(symbols, spark.createDataFrame(rows, "symbol string, date date"), "2026-01-05", "2026-01-14").collect()
    assert {r["symbol"]: (r["n"], r["has_coverage"]) for r in found} == {"A": (5, True), "B": (4, False), "C": (5, False), "D": (0, False)}


GOLDEN = [("05:00:10", 100), ("05:00:50", 120), ("05:02:00", 150), ("05:03:00", 150), ("05:04:00", 140), ("05:05:00", None), ("05:06:00", 200), ("18:59:00", 210), ("19:00:00", 220)]
DELTAS = [None, 30, 0, None, None, None, 10, None]


def test_volume_delta(spark):
    rows = [("A", dt.datetime.fromisoformat(f"2026-01-05 {t}"), k, v) for k, (t, v) in enumerate(GOLDEN)]
    frame = spark.createDataFrame(rows, "symbol string, ts timestamp, seq int, volume long")
    found = intraday.volume_delta(intraday.latest_per_bucket(frame)).orderBy("bucket").collect()
    assert [r["volume_delta"] for r in found] == DELTAS


def test_streamed_volume_delta(spark, tmp_path):
    rows = [("A", dt.datetime.fromisoformat(f"2026-01-05 {t}"), v) for t, v in GOLDEN[1:]]
    schema = "symbol string, scraped_at timestamp, volume long"
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.volume_deltas(streaming.snapshots(spark, str(tmp_path / "in"), schema))
    done = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    done.awaitTermination(90)
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("bucket").collect()
    assert [r["volume_delta"] for r in found] == DELTAS


def test_stasis_cycles():
    at = lambda m: pd.Timestamp("2026-01-05") + pd.Timedelta(minutes=m)
    halted, _ = streaming.stasis_cycles([(at(m), 5) for m in (0, 2, 4, 23, 24, 26, 28, 30, 49, 50)])
    assert [k for k, h in enumerate(halted) if h] == [4, 9]
    assert not any(streaming.stasis_cycles([(at(m), 0) for m in range(0, 90, 2)])[0])
    assert not any(streaming.stasis_cycles([(at(m), m // 20) for m in range(20, 90, 2)])[0])


def test_table_upsert(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), "symbol string, date date, close bigint, createdAt timestamp, updatedAt timestamp", ["symbol", "date"])
    rows = lambda *v: spark.createDataFrame([(s, D(2026, 1, 1), c) for s, c in v], "symbol string, date date, close bigint")
    assert table.upsert(rows(("A", 1), ("B", 2)), "2026-01-02") == (2, 0)
    assert table.upsert(rows(("B", 3), ("C", 4)), "2026-01-03") == (1, 1)
    assert table.upsert(rows(("B", 3), ("C", 4)), "2026-01-03") == (0, 2)
    found = {r["symbol"]: (r["close"], r["createdAt"].day, r["updatedAt"].day) for r in table.read().collect()}
    assert found == {"A": (1, 2, 2), "B": (3, 2, 3), "C": (4, 3, 3)}
    assert store.repeated_keys(table.read(), ["symbol", "date"]).isEmpty()


RECORDED = "equitylake.sources.pages:recorded_page"


def test_page_source(spark):
    ranges = spark.createDataFrame([("A", D(2025, 12, 5), D(2026, 2, 1)), ("A", D(2026, 1, 1), D(2026, 1, 2)), ("B", D(2026, 1, 31), D(2026, 1, 31)), ("C", D(2026, 2, 2), D(2026, 2, 1))], "symbol string, start date, end date")
    worklist = pages.months_to_fetch(ranges)
    assert sorted(tuple(r) for r in worklist.collect()) == [("A", 2025, 12), ("A", 2026, 1), ("A", 2026, 2), ("B", 2026, 1)]
    held = [("A/2025/12", "a"), ("A/2026/1", "b"), ("B/2026/1", "c"), ("B/2026/2", "d")]
    where = pages.record_pages(spark.createDataFrame(held, "key string, html string"), 3)
    found = pages.fetched_pages(worklist, RECORDED, where, 3)
    assert sorted(tuple(r) for r in found.collect()) == [("A", 2025, 12, "a"), ("A", 2026, 1, "b"), ("B", 2026, 1, "c")]
    asked = found.where("symbol = 'A' and year >= 2026 and month in (1, 2) and html <> ''")
    assert [tuple(r) for r in asked.collect()] == [("A", 2026, 1, "b")]
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "html" in plan and "2026" not in plan and " IN " not in plan  # Spark is left with the html's filter
    assert pages.fetched_pages(worklist.where("false"), RECORDED, where).isEmpty()


def test_pushed_filters_spare_fetches(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull

    spark.createDataFrame([("A", 2025, 1), ("A", 2026, 1), ("B", 2026, 1)], "symbol string, year int, month int").coalesce(1).write.parquet(str(tmp_path / "w"))
    reader = pages.PageReader({"worklist": f"file://{tmp_path}/w", "fetcher": RECORDED})
    left = list(reader.pushFilters([EqualTo(("symbol",), "A"), GreaterThan(("year",), 2025), In(("month",), (1,)), EqualTo(("html",), "x"), IsNotNull(("year",))]))
    assert [f.attribute for f in left] == [("html",), ("year",)]
    assert [k for part in reader.partitions() for k in reader.wanted(part.path)] == [("A", 2026, 1)]


def test_schedule_finds_a_batch_again(spark, tmp_path):
    path = pages.schedule(spark.range(10).withColumnRenamed("id", "page_id"), "page_id", 4, f"file://{tmp_path}/s")
    reader = pages.ScheduleReader({"worklist": path, "key": "key"})
    first, end = reader.read(reader.initialOffset())
    assert sorted(first) == [(k, str(k)) for k in range(4)] and end == {"chunk": 1}
    second, end = reader.read(end)
    rest, last = reader.read(end)
    assert sorted([*second, *rest]) == sorted(reader.readBetweenOffsets({"chunk": 1}, {"chunk": 3})) == [(k, str(k)) for k in range(4, 10)]
    assert list(reader.read(last)[0]) == [] and reader.read(last)[1] == last == {"chunk": 3}


def test_filters(spark):
    frame = spark.createDataFrame([("A", 1.0, None), ("B", None, True), ("C", 3.0, False)], "symbol string, x double, ok boolean")
    names = lambda q: {r["symbol"] for r in frame.where(filters.compile_filter(q)).collect()}
    assert names({"x": {"$ne": 1.0}}) == {"B", "C"} and names({"x": None}) == {"B"} and names({"ok": {"$exists": True}}) == {"B", "C"}
    assert names({"$nor": [{"symbol": "A"}, {"x": {"$gte": 3}}]}) == {"B"} and names({}) == {"A", "B", "C"}


def test_nearest_match_is_that_of_all_pairs(spark):
    rng = random.Random(3)
    day = lambda: D(2026, 1, 1) + dt.timedelta(days=rng.randrange(300))
    records = [(k, rng.choice("ABC"), day()) for k in range(120)]
    held = sorted({(rng.choice("ABC"), day()) for _ in range(40)})
    found = corporate.nearest_match(spark.createDataFrame(records, "rid int, symbol string, exDate date"), spark.createDataFrame([(*h, 1.0) for h in held], "symbol string, exDate date, amount double"), 7).collect()
    for r in found:
        near = sorted((abs((d - r["exDate"]).days), d) for s, d in held if s == r["symbol"] and abs((d - r["exDate"]).days) <= 7)
        assert r["db_date"] == (near[0][1] if near else None)


def quote_page(price, reg="", other="", css="change__text--pos", date="As of Wed, Jun 24, 2026 3:48 PM"):
    return (
        f'<div class="company__quote"><div class="quote__name"> Alpha Ltd<br>DELISTED</div><div class="quote__sector">x <span>CEMENT</span></div><div class="quote__close">{price}</div>'
        f'<div class="quote__change {css}"><div class="change__value">1.5</div><div class="change__percent">(2.25%)</div></div><div class="quote__date">{date}</div>'
        f'<div class="tabs__panel" data-name="FUT">{other}</div><div class="tabs__panel" data-name="REG">{reg}</div></div>'
    )


def stat(label, value):
    return f'<div class="stats_item"><div class="stats_label">{label}</div><div class="stats_value">{value}</div></div>'


def test_company_quotes(spark):
    reg = stat("Open", "410.00") + stat("Volume", "1,234") + stat("P/E Ratio (TTM) **", "7.5") + '<div class="company__quote__rangeStats">' + stat("CIRCUIT BREAKER", '<div class="numRange" data-low="1" data-high="2"></div>') + stat("DAY RANGE", "411.72 – 503.22") + "</div>"
    at = [dt.datetime(2026, 6, 24, 11), dt.datetime(2026, 6, 24, 12)]
    rows = [(" abc", quote_page("Rs.411.72", reg, stat("Open", "9.99")), at[0]), ("abc", quote_page("Rs.1,500.00", reg), at[1]), ("X", quote_page("", css="", date="soon"), at[0]), ("Y", "<p>none</p>", at[0]), ("Z", None, at[0])]
    found = html.company_quotes(spark.createDataFrame(rows, "symbol string, html string, scraped_at timestamp"))
    assert found.schema.simpleString() == spark.createDataFrame([], schemas.QUOTE).schema.simpleString()
    got = sorted((r["symbol"], r["scraped_at"], r["price"], r["open"], r["volume"], r["pe_ratio_ttm"], r["circuit_breaker_high"], r["day_range_low"], r["change_direction"], r["as_of"], r["name"], r["sector"]) for r in found.collect() if r["symbol"] != "X")
    same = (410.0, 1234, 7.5, 2.0, 411.72, "up", dt.datetime(2026, 6, 24, 10, 48), "Alpha Ltd", "CEMENT")
    assert got == [("ABC", at[0], 411.72, *same), ("ABC", at[1], 1500.0, *same)]
    bare = found.where("symbol = 'X'").first()
    assert (bare["price"], bare["as_of"], bare["open"], bare["change_direction"]) == (None, None, None, "down")


def test_reports(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = spark.createDataFrame([("A", D(2026, 1, 5), D(2026, 1, 7)), ("A", D(2026, 1, 1), D(2026, 1, 2)), ("B", D(2026, 2, 1), D(2026, 2, 2))], "symbol string, start date, end date")
    read = lambda: sorted(tuple(r) for r in readers.gap_report(spark, path, schemas.MISSING_REPORT).collect())
    assert read() == []
    assert tables.write_report(rows, path, ["start", "end"]) and read() == sorted(tuple(r) for r in rows.collect())
    assert not tables.write_report(rows.where("false"), path, ["start", "end"]) and len(read()) == 3
    held = readers.gap_report(spark, path, schemas.MISSING_REPORT)
    assert tables.write_report(held.where("symbol = 'A'"), path, ["start", "end"]) and {r[0] for r in read()} == {"A"}
    assert not tables.write_report(rows.where("false"), path, ["start", "end"], keep_if_empty=False) and read() == []
    one = tmp_path / "one.json"
    one.write_text('{\n    "A": [\n        {"start": "2026-01-05", "end": "2026-01-07"}\n    ]\n}')
    assert [tuple(r) for r in readers.gap_report(spark, str(one), schemas.MISSING_REPORT).collect()] == [("A", D(2026, 1, 5), D(2026, 1, 7))]
    one.write_text("{broken")
    assert readers.gap_report(spark, str(one)).isEmpty()


def test_table_versions(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), "symbol string, x int", ["symbol"])
    for k in range(4):
        table.append(spark.createDataFrame([(f"S{k}", k)], table.schema))
    assert table.versions() == [3, 4] and table.read().count() == 4
    (tmp_path / "t" / "v-000000005").mkdir()  # a writer that did not end
    assert table.read().count() == 4
    with pytest.raises(Exception, match="(?i)exists"):
        table.append(spark.createDataFrame([("S9", 9)], table.schema))
    nulls = tables.Table(spark, str(tmp_path / "n"), "symbol string, as_of date, x int", ["symbol", "as_of"])
    row = lambda x: spark.createDataFrame([("A", None, x), ("A", None, x - 1)], "symbol string, as_of date, x int")
    assert nulls.upsert(row(2), "2026-01-01") == (1, 0) and nulls.upsert(row(5), "2026-01-01", F.col("x")) == (0, 1)
    assert [tuple(r) for r in nulls.read().collect()] == [("A", None, 5)]


def partitioned(spark, path):
    table = tables.Table(spark, path, "symbol string, x int, day date", ["symbol", "day"], ["day"])
    return table, lambda *v: spark.createDataFrame(list(v), "symbol string, x int, day date")


def test_partitioned_upsert_leaves_other_partitions(spark, tmp_path):
    table, rows = partitioned(spark, str(tmp_path / "t"))
    assert table.upsert(rows(("A", 1, D(2026, 1, 1)), ("A", 2, D(2026, 1, 2)), ("N", 9, None)), "2026-01-01") == (3, 0)
    before = table.manifest(1)
    assert set(before) == {("2026-01-01",), ("2026-01-02",), (None,)}
    assert table.upsert(rows(("A", 3, D(2026, 1, 2)), ("B", 4, D(2026, 1, 2))), "2026-01-02") == (1, 1)
    after = table.manifest(2)
    assert {k for k in after if after[k] == before.get(k)} == {("2026-01-01",), (None,)}
    assert sorted((r["symbol"], r["x"]) for r in table.read().collect()) == [("A", 1), ("A", 3), ("B", 4), ("N", 9)]
    assert sorted(r["x"] for r in table.read(1).collect()) == [1, 2, 9]
    assert [r["x"] for r in table.read(partitions=lambda v: v == ("2026-01-01",)).collect()] == [1]
    assert table.upsert(rows(("N", 8, None)), "2026-01-03") == (0, 1)
    assert table.versions() == [2, 3] and sorted(r["x"] for r in table.read().collect()) == [1, 3, 4, 8]
    held = {p.name for p in (tmp_path / "t" / "data").iterdir()}
    assert held >= {f.split("/")[0] for v in (2, 3) for f in table.manifest(v).values()}
    table.replace(rows(("Z", 0, D(2027, 1, 1))))
    assert [tuple(r) for r in table.read().collect()] == [("Z", 0, D(2027, 1, 1))]


def test_a_crash_leaves_the_version_before(spark, tmp_path, monkeypatch):
    table, rows = partitioned(spark, str(tmp_path / "t"))
    table.upsert(rows(("A", 1, D(2026, 1, 1))), "2026-01-01")

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(table, "_commit", crash)
    with pytest.raises(RuntimeError, match="lost"):
        table.upsert(rows(("A", 2, D(2026, 1, 1)), ("B", 3, D(2026, 1, 2))), "2026-01-02")
    again, _ = partitioned(spark, str(tmp_path / "t"))
    assert [(r["symbol"], r["x"]) for r in again.read().collect()] == [("A", 1)]
    assert again.upsert(rows(("B", 3, D(2026, 1, 2))), "2026-01-02") == (1, 0)
    assert sorted(r["x"] for r in again.read().collect()) == [1, 3]


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    one, rows = partitioned(spark, str(tmp_path / "t"))
    two, _ = partitioned(spark, str(tmp_path / "t"))
    one.upsert(rows(("A", 1, D(2026, 1, 1))), "2026-01-01")
    write = two._write_partitions

    def meanwhile(frame):
        made = write(frame)
        one.upsert(rows(("A", 2, D(2026, 1, 1))), "2026-01-02")  # ends first
        return made

    monkeypatch.setattr(two, "_write_partitions", meanwhile)
    with pytest.raises(tables.Conflict):
        two.upsert(rows(("A", 3, D(2026, 1, 1))), "2026-01-03")
    assert [r["x"] for r in one.read().collect()] == [2] and one.versions() == [1, 2]
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == {f.split("/")[0] for v in (1, 2) for f in one.manifest(v).values()}
    monkeypatch.setattr(two, "_write_partitions", write)
    assert two.upsert(rows(("A", 3, D(2026, 1, 1))), "2026-01-03") == (0, 1)


def drain(query):
    ended = query.awaitTermination(120)
    query.stop()
    assert ended and query.exception() is None


def test_streamed_upserts_and_bars(spark, tmp_path):
    schema = "symbol string, scraped_at timestamp, volume long"
    for t, v in GOLDEN:
        spark.createDataFrame([("A", dt.datetime.fromisoformat(f"2026-01-05 {t}"), v)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = tables.Table(spark, str(tmp_path / "t"), schema + ", scraped_at_minute timestamp", ["symbol", "scraped_at_minute"])
    stream = streaming.snapshots(spark, str(tmp_path / "in"), schema, 3)
    drain(streaming.write_upserts(streaming.with_minute(stream), table, str(tmp_path / "c"), trigger={"availableNow": True}))
    want = [v for t, v in GOLDEN[1:]]
    assert [r["volume"] for r in table.read().orderBy("scraped_at_minute").collect()] == want
    drain(streaming.minute_bars(stream).writeStream.format("memory").queryName("bars").outputMode("complete").trigger(availableNow=True).start())
    assert [r["volume"] for r in spark.table("bars").orderBy("bucket").collect()] == want


def test_streamed_halts(spark, tmp_path):
    at = lambda m: dt.datetime(2026, 1, 5) + dt.timedelta(minutes=m)
    schema = "market string, cycle_ts timestamp, total long"
    minutes = (0, 2, 4, 23, 24, 26, 28, 30, 49, 50)
    for m in minutes:
        spark.createDataFrame([("M", at(m), 5), ("N", at(m), m)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.halts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in")))
    drain(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    found = spark.read.parquet(str(tmp_path / "out")).where("halted").orderBy("cycle_ts").collect()
    assert [(r["market"], r["cycle_ts"]) for r in found] == [("M", at(24)), ("M", at(50))]


def test_market_watch_job(spark, tmp_path):
    def page(volume):
        cells = ["<td data-order='A' data-title='Name'>A</td>", "<td>801</td>", "<td>I</td>"] + ["<td data-order='1.5'>x</td>"] * 7 + [f"<td data-order='{volume}'>x</td>"]
        return "<table><tr>" + "".join(cells) + "</tr></table>"

    for t, v in [("05:00:10", 100), ("05:02:00", 150), ("05:03:00", 140)]:
        spark.createDataFrame([(page(v), dt.datetime.fromisoformat(f"2026-01-05 {t}"))], "html string, scraped_at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = tables.Table(spark, str(tmp_path / "t"), schemas.MARKET_WATCH + ", scraped_at timestamp, scraped_at_minute timestamp, volume_delta bigint, day date", ["symbol", "scraped_at_minute"], ["day"])
    stream = streaming.snapshots(spark, str(tmp_path / "in"), "html string, scraped_at timestamp", 1)
    reports = []
    drain(streaming.poll_watch(stream, table, str(tmp_path / "c"), {"availableNow": True}, reports.append))
    assert [r["volume_delta"] for r in table.read().orderBy("scraped_at_minute").collect()] == [None, 50, None]
    assert [(r["symbol_count"], r["total_volume"], r["inserted"], r["updated"]) for r in reports] == [(1, 100, 1, 0), (1, 150, 1, 0), (1, 140, 1, 0)]


def test_numbering_is_a_permutation_at_size(spark):
    rows = spark.range(3_000_000, numPartitions=16).select((F.xxhash64("id") % 100_000).alias("symbol"), "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    placed = ranks.numbered(rows, [F.col("symbol").asc(), F.col("id").asc()])
    found = placed.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank"), F.countDistinct("id")).first()
    assert tuple(found) == (3_000_000, 3_000_000, 0, 2_999_999, 3_000_000)
    both = placed.select("rank", "symbol", "id")
    later = both.select((F.col("rank") - 1).alias("rank"), F.col("symbol").alias("s"), F.col("id").alias("i"))
    assert both.join(later, "rank").where("struct(symbol, id) > struct(s, i)").isEmpty()


def test_numbering_of_ties_and_nothing(spark):
    rows = spark.createDataFrame([("A", {"k": 1})] * 50 + [("B", None), (None, None)], "symbol string, m map<string,int>")
    assert sorted(r["rank"] for r in ranks.numbered(rows, [F.col("symbol").asc()]).collect()) == list(range(52))
    assert ranks.numbered(rows.where("false"), [F.col("symbol").asc()]).isEmpty()


def test_missing_spans_are_those_of_all_dates(spark):
    rng = random.Random(6)
    first = D(2026, 1, 5)
    calendar = [first + dt.timedelta(days=k) for k in range(120) if (first + dt.timedelta(days=k)).weekday() < 5 and not 30 <= k <= 44]
    held = {s: {d for d in calendar if rng.random() < p} for s, p in (("A", 0.5), ("B", 0.95), ("C", 0.1), ("D", 0), ("E", 1))}
    history = spark.createDataFrame([(s, d) for s in held for d in held[s]] + [("A", D(2030, 1, 1)), ("X", first), (None, first)], "symbol string, date date")
    symbols = spark.createDataFrame([(s,) for s in held] + [(None,)], "symbol string")
    days = spark.createDataFrame([(d,) for d in calendar], "date date")
    missing = {(s, d) for s in held for d in calendar if d not in held[s]}
    assert {tuple(r) for r in gaps.missing_dates(symbols, days, history).collect()} == missing
    frame = spark.createDataFrame(sorted(missing), "symbol string, date date")
    for threshold in (0, 3):
        ranges = gaps.missing_ranges(gaps.missing_spans(symbols, days, history), threshold)
        assert {tuple(r) for r in ranges.collect()} == {tuple(r) for r in gaps.missing_ranges(frame, threshold).collect()}
    assert "Cartesian" not in ranges._jdf.queryExecution().toString() and "NestedLoop" not in ranges._jdf.queryExecution().executedPlan().toString()
    assert gaps.missing_spans(symbols, days.where("false"), history).isEmpty()


def test_days_outside_ranges(spark):
    rng = random.Random(9)
    day = lambda: D(2026, 1, 1) + dt.timedelta(days=rng.randrange(200))
    ranges = [(rng.choice("AB"), a, a + dt.timedelta(days=rng.randrange(-3, 50))) for a in (day() for _ in range(20))] + [("A", None, D(2026, 1, 1)), ("B", D(2026, 1, 1), None)]
    days = [(m, D(2026, 1, 1) + dt.timedelta(days=k)) for m in "ABC" for k in range(260)] + [("A", None)]
    closed = lambda m, d: d is not None and any(r[0] == m and r[1] and r[2] and r[1] <= d <= r[2] for r in ranges)
    frame = spark.createDataFrame(ranges, "market string, start date, end date")
    left = calendars.outside(spark.createDataFrame(days, "market string, date date"), frame, ["market"])
    assert {tuple(r) for r in left.collect()} == {d for d in days if not closed(*d)}
    assert "NestedLoop" not in left._jdf.queryExecution().executedPlan().toString()
    for r in calendars.merged_ranges(frame, ["market"]).collect():
        assert all(closed(r["market"], r["start"] + dt.timedelta(days=k)) for k in range((r["end"] - r["start"]).days + 1)) and r["start"].month == r["end"].month
    assert calendars.business_calendar(spark, "2026-01-05", "2026-01-16", frame.where("false").drop("market")).count() == 10
    assert calendars.business_calendar(spark, "2026-01-05", "2026-01-16", [("2026-01-06", "2026-01-07"), ("2026-01-07", "2026-01-08")]).count() == 7


@pytest.mark.parametrize("tolerance", [0, 7, 365])
def test_nearest_match_with_ties_and_eras(spark, tolerance):
    rng = random.Random(tolerance)
    day = lambda: D(2015, 1, 1) + dt.timedelta(days=rng.randrange(5000))
    records = [(k, rng.choice("AB"), day()) for k in range(300)] + [(900, "A", None), (901, None, D(2020, 1, 1)), (902, "Z", D(2020, 1, 1))]
    held = [(rng.choice("AB"), day(), float(rng.randrange(3))) for _ in range(200)]
    held += [(s, d, a + 1) for s, d, a in held[:50]] + [(s, d, 5.0) for _, s, d in records[:20]]
    found = corporate.nearest_match(spark.createDataFrame(records, "rid int, symbol string, exDate date"), spark.createDataFrame(held, "symbol string, exDate date, amount double"), tolerance).collect()
    assert len(found) == len(records)
    for r in found:
        near = sorted((abs((d - r["exDate"]).days), d, a) for s, d, a in held if r["exDate"] and s == r["symbol"] and abs((d - r["exDate"]).days) <= tolerance)
        assert (r["date_diff"], r["db_date"], r["db_amount"]) == (near[0] if near else (None, None, None))


def test_null_keys_meet(spark):
    schema = "symbol string, exDate date, n int"
    target = spark.createDataFrame([("A", None, 1)], schema)
    source = spark.createDataFrame([("A", None, 2), (None, None, 4), (None, None, 3), ("B", D(2026, 1, 1), 6), ("B", D(2026, 1, 1), 5)], schema)
    kept = store.insert_ignore(target, source, ["symbol", "exDate"], F.col("n"))
    assert sorted(r["n"] for r in kept.collect()) == [1, 3, 5]
    stored = spark.createDataFrame([("A", D(2026, 5, 1), 1), (None, D(2026, 5, 1), 2), ("C", D(2026, 5, 1), 3)], schema)
    left = store.delete_orphans(stored, stored.where("n <> 3"), ["symbol", "exDate"], "2026-01-01", "x", F.lit("x"))
    assert sorted(r["n"] for r in left.collect()) == [1, 2]


def test_rejects_tell_why(spark):
    good = "<td data-order='S'>S</td>" + "<td data-order='1'>x</td>" * 10
    page = f"<tr><th>h</th></tr><tr>{good}</tr><tr><td>U</td><td>801</td></tr><tr>{good.replace('S', '')}</tr>"
    parsed = html.market_watch_parsed(spark.createDataFrame([(page, dt.datetime(2026, 1, 1)), (None, None)], "html string, scraped_at timestamp"))
    assert [r["symbol"] for r in html.good_rows(parsed).collect()] == ["S"]
    assert sorted((r["reason"], r["symbol"], len(r["texts"])) for r in html.rejected_rows(parsed).collect()) == [("cells", "U", 2), ("symbol", "", 11)]


def test_deeply_nested_company_page(spark):
    page = "<p>" * 3000 + "<b>" * 3000 + quote_page("Rs.1.00", stat("Open", "410.00") + "<i>" * 5000 + stat("Volume", "7"))
    assert html.quote_texts(page)["open"] == "410.00" and html.quote_texts(page)["volume"] == "7"
    found = html.company_quotes(spark.createDataFrame([("A", page, dt.datetime(2026, 1, 1)), ("B", quote_page("Rs.2.00"), dt.datetime(2026, 1, 1))], "symbol string, html string, scraped_at timestamp"))
    assert {(r["symbol"], r["price"]) for r in found.collect()} == {("A", 1.0), ("B", 2.0)}


def test_stasis_of_one_sequence_is_that_of_one_market(spark, monkeypatch):
    monkeypatch.setattr(intraday, "BLOCK", 7)
    rng = random.Random(1)
    rows = [(dt.datetime(2026, 1, 5) + dt.timedelta(minutes=5 * k), rng.choice([0, 4, 4, 4, 5])) for k in range(200)] + [(dt.datetime(2026, 1, 6) + dt.timedelta(minutes=k), 8) for k in range(90)]
    frame = spark.createDataFrame(rows, "cycle_ts timestamp, total long")
    alone = intraday.stasis(frame, 3, 20).select("cycle_ts", "total", "run_start", "stale")
    together = intraday.stasis(frame.withColumn("m", F.lit(1)), 3, 20, "m").select("cycle_ts", "total", "run_start", "stale")
    assert sorted(map(tuple, alone.collect()), key=str) == sorted(map(tuple, together.collect()), key=str)
    assert alone.where("stale").count() > 60


def test_long_lists_of_a_range_are_parted(spark):
    ranges = spark.createDataFrame([(s, D(2026, 1, 1), D(2026, 1, 9)) for s in "ABCDE"] + [("A", D(2026, 2, 1), D(2026, 2, 2))], "symbol string, start date, end date")
    found = gaps.ranges_to_symbols(ranges, 2, 2).orderBy("part").collect()
    assert [(r["n_symbols"], r["part"], r["symbols"]) for r in found] == [(5, 0, "A,B"), (5, 1, "C,D"), (5, 2, "E")]
    report = spark.createDataFrame([("C", 0), ("A", 1), ("B", 2), ("A", 3)], "symbol string, pos int")
    assert {r["symbol"] for r in gaps.first_symbols(report, 2, "pos").collect()} == {"A", "C"} and {r["symbol"] for r in gaps.first_symbols(report, 2).collect()} == {"A", "B"}


def streamed(spark, tmp_path, make, schema, *batches, **trigger):
    """The stream's rows after each batch of input, one run a batch, the same checkpoint."""
    out = []
    for rows in batches:
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = make(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        drain(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(**(trigger or {"availableNow": True})).start())
        out.append(sorted(tuple(r) for r in spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()))
    return out


SNAPSHOT = "symbol string, scraped_at timestamp, volume long"


def snapshot(t, volume):
    return ("A", dt.datetime.fromisoformat(f"2026-01-05 {t}"), volume)


def test_late_snapshots_overwrite_their_minute(spark, tmp_path):
    at = lambda t: dt.datetime.fromisoformat(f"2026-01-05 {t}")
    first, second, third = streamed(
        spark, tmp_path, lambda s: streaming.volume_deltas(s, "10 minutes"), SNAPSHOT,
        [snapshot("05:03:00", 130), snapshot("05:01:30", 110), snapshot("05:01:10", 100)], [snapshot("05:02:00", 125), snapshot("05:30:00", 150)], [snapshot("05:04:00", 1), snapshot("05:31:00", 170)],
    )
    assert first == [("A", at("05:01:00"), 110, None), ("A", at("05:03:00"), 130, 20)]
    assert set(second) - set(first) == {("A", at("05:02:00"), 125, 15), ("A", at("05:30:00"), 150, 20)}
    assert set(third) - set(second) == {("A", at("05:31:00"), 170, 20)}  # 05:04 is behind the watermark


def test_minutes_expire(spark, tmp_path):
    def later(stream):
        time.sleep(3)
        return streaming.volume_deltas(stream, ttl_hours=2 / 3600)

    first, second = streamed(spark, tmp_path, later, SNAPSHOT, [snapshot("05:01:00", 100)], [snapshot("05:02:00", 110), snapshot("05:03:00", 125)], once=True)
    assert [r[3] for r in second] == [None, None, 15] and len(first) == 1


def test_a_halt_is_reported_without_a_cycle(spark, tmp_path):
    at = lambda m: dt.datetime(2026, 1, 5) + dt.timedelta(minutes=m)
    cycles = lambda market, *ms: [(market, at(m), 5) for m in ms]
    first, second = streamed(
        spark, tmp_path, lambda s: streaming.halts(s, 3, 20, "5 minutes"), "market string, cycle_ts timestamp, total long",
        [*cycles("M", 4, 0, 2), *cycles("N", 1)], [*cycles("N", 40), ("M", at(39), 6)],
    )
    assert [r for r in first if r[3]] == []
    assert [r for r in second if r[3]] == [("M", at(24), 5, True)]


def test_repeated_symbols_and_orderless_keys(spark):
    stocks = spark.createDataFrame([("A", 5.0), ("A", 10.0), ("B", None)], "symbol string, faceValue double")
    rows = spark.createDataFrame([("A", 20.0, D(2026, 1, 1), ["dividend"]), ("B", 20.0, D(2026, 1, 1), ["dividend"])], "symbol string, dividend double, x_date date, announcement_type array<string>")
    assert sorted((r["symbol"], r["amountPerShare"]) for r in corporate.dividends(rows, stocks).collect()) == [("A", 2.0), ("B", 2.0)]
    assert store.one_per_key(stocks.select("symbol"), ["symbol"]).count() == 2


@pytest.mark.parametrize("text,want", [("2026-03-19", D(2026, 3, 19)), ("2026-03-19T10:00:00Z", D(2026, 3, 19)), ("2026-03-19 or so", None), ("x", None)])
def test_iso_date(spark, text, want):
    assert one(spark, text, scalars.iso_date) == want


def test_schemas(spark):
    for ddl in (schemas.PRICE_HISTORY, schemas.STOCKS, schemas.QUOTE, schemas.DIVIDEND, schemas.BONUS, schemas.MARKET_WATCH, schemas.FAILED_INTERVAL):
        assert spark.createDataFrame([], ddl).isEmpty()


def test_recorded_pages_lie_in_bounded_shelves(spark):
    """A worker holds a few row groups of recorded pages, however many there are."""
    rng = random.Random(5)
    held = {f"S{k}/{k % 7}": "".join(rng.choice("abcdef<>/") for _ in range(2000)) for k in range(3000)}
    where = pages.record_pages(spark.createDataFrame(list(held.items()), "key string, html string"), 100_000)
    last, places = pages._shelves(where)
    assert last == sorted(last) and len(places) > 20 and pages._shelf.cache_info().maxsize <= 8
    assert max(sum(map(len, pages._shelf(*p).values())) for p in places) < 1_000_000
    assert all(pages.recorded_page(where, *key.split("/")) == html for key, html in list(held.items())[::50])
    assert pages.recorded_page(where, "S1", 2) is None and pages.recorded_page(where, "zz") is None


def test_cells_of_plain_markup_as_the_parser_finds_them():
    """Pages that are read as plain markup against the parser, whole and in pieces."""

    def parsed(page, step):
        parser = html.Cells()
        for k in range(0, len(page), step):
            parser.feed(page[k : k + step])
        return [r for r in parser.rows if r]

    rng = random.Random(6)
    parts = ["<tr>", "</tr>", "<td>", "</td>", '<td data-order="1.5" class="a b">', '<div class="c">', "</div>", "x", " 1,200 ", "\u2013", "<br>", '<td data-order="">', "</table>"]
    odd = ["&amp;", "&", "<br/>", "<!-- <td> -->", "<TD>", "<td a=b>", "<script>", "</script>", "<", ">", "<title>", "<td a='x'>", "<p a>"]
    plain = 0
    for n in range(3000):
        page = "".join(rng.choice(parts + odd if n % 2 else parts) for _ in range(rng.randrange(40)))
        plain += html.is_plain(page)
        assert list(html.cells(page)) == parsed(page, 1 << 20)
    assert plain > 1000 and html.cells(None) is not None and list(html.cells(None)) == []


def test_rows_of_a_page_come_in_bounded_frames():
    page = "<table>" + "<tr><td>1</td></tr>" * 5000 + "</table>"
    rows = html.cells(page)
    assert next(rows) and len(list(html.frames_of(((r[0][0],) for r in rows), ["c"]))) == 3


def test_minutes_of_a_symbol_are_put_at_once():
    """A symbol's batch calls the state store twice, however many minutes it has."""
    from equitylake.streaming.intraday import VolumeDelta

    class Held:
        def __init__(self):
            self.rows, self.calls = [], 0

        def get(self):
            self.calls += 1
            return iter(self.rows)

        def put(self, rows):
            self.calls += 1
            self.rows = rows

    class Handle:
        held = Held()

        def getListState(self, *_, **__):
            return self.held

    class Times:
        now = 10**12

        def getCurrentProcessingTimeInMs(self):
            return self.now

    processor = VolumeDelta(48)
    processor.init(Handle())
    at = pd.date_range("2026-01-05 04:00", periods=300, freq="min")
    put = lambda times, volumes: pd.concat(processor.handleInputRows(("A",), iter([pd.DataFrame({"scraped_at": times, "volume": volumes})]), Times()))
    out = put(at[::2], range(0, 300, 2))
    assert Handle.held.calls == 2 and len(Handle.held.rows) == 150 and out["volume_delta"].isna().sum() == 1 and (out["volume_delta"].dropna() == 2).all()
    Times.now += 47 * 3_600_000
    assert put(at[1::2], range(1, 301, 2))["volume_delta"].tolist() == [1] * 150
    Times.now += 2 * 3_600_000  # the first ones have lived their time, the others have not
    assert put(at[-1:] + pd.Timedelta("1min"), [301])["volume_delta"].tolist() == [2] and len(Handle.held.rows) == 151


def test_rows_by_date_are_parsed_once(spark):
    """A sort draws its bounds in a run of its own: that must not parse the pages again."""
    page = "<table><tr>" + "<td>Jan 2, 2026</td>" + "<td>1</td>" * 5 + "</tr></table>"
    rows = history.preprocess(html.history_rows(spark.createDataFrame([("A", page), ("B", page)], "symbol string, html string")))
    found = history.by_date(rows)
    assert "MapInPandas" not in found._jdf.queryExecution().toString() and [r["symbol"] for r in found.collect()] == ["A", "B"]
