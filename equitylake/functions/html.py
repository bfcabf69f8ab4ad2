"""HTML pages to rows with the standard library's parser, in Arrow-fed pandas functions."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import OHLCV_RAW, QUOTE
from ..session import narrow_batches
from . import scalars as S

# The columns of a history page.
HEADERS = ("TIME", "OPEN", "HIGH", "LOW", "CLOSE", "VOLUME")


# Rows to a frame, and characters of a page to a parser, at once.
ROWS, CHARS = 2000, 1 << 16

# Plain markup, in which a parser finds just these tags and texts: no reference, comment or
# other declaration, attributes quoted and in lower case, no element whose text is no markup.
_TAG = r'<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*+))>([^<&]*+)'
_TAGS = re.compile(_TAG)
_PLAIN = re.compile(f"[^<&]*+(?:{_TAG})*+")
_ATTRIBUTES = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
_RAW = re.compile(r"<(?:script|style|textarea|title|iframe|noembed|noframes|noscript|xmp|plaintext)\b")


def is_plain(html: str) -> bool:
    return _PLAIN.fullmatch(html) is not None and _RAW.search(html) is None


def feed_plain(parser: HTMLParser, html: str) -> Iterator[None]:
    """A plain page's tags and texts to the parser's handlers, a stop before each row."""
    if before := html[: html.find("<") if "<" in html else None]:
        parser.handle_data(before)
    for found in _TAGS.finditer(html):
        end, tag, attributes, text = found.groups()
        if end:
            parser.handle_endtag(end)
        else:
            if tag == "tr":
                yield
            parser.handle_starttag(tag, _ATTRIBUTES.findall(attributes) if attributes else [])
        if text:
            parser.handle_data(text)


class Cells(HTMLParser):
    """Rows of table cells: (text, attributes, classes of anything inside)."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, dict, str]]] = []
        self.cell: list | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attributes = dict(attrs)
        if tag == "tr":
            self.rows.append([])
        elif tag == "td" and self.rows:
            self.cell = ["", attributes, attributes.get("class") or ""]
        elif self.cell is not None:
            self.cell[2] += " " + (attributes.get("class") or "")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "tr") and self.cell is not None:
            self.rows[-1].append((self.cell[0].strip(), self.cell[1], self.cell[2]))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell[0] += data


def fed(parser: HTMLParser, html: str) -> Iterator[None]:
    for k in range(0, len(html), CHARS):
        parser.feed(html[k : k + CHARS])
        yield


def cells(html: str | None) -> Iterator[list[tuple[str, dict, str]]]:
    """The rows with cells of a page, as soon as another has begun."""
    parser, html = Cells(), html or ""
    for _ in feed_plain(parser, html) if is_plain(html) else fed(parser, html):
        yield from filter(None, parser.rows[:-1])
        del parser.rows[:-1]
    yield from filter(None, parser.rows)


def frames_of(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows in frames of ``ROWS``, so that a worker holds no more of them."""
    for part in batched(rows, ROWS):
        yield pd.DataFrame(list(part), columns=columns)


def history_rows(pages: DataFrame) -> DataFrame:
    """(symbol, TIME ... VOLUME) of pages (symbol, html): a row for each table row with at
    least six cells; further cells are dropped, shorter rows left out."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = ((s, *(c[0] for c in r[:6])) for s, h in zip(frame["symbol"], frame["html"]) for r in cells(h) if len(r) >= 6)
            yield from frames_of(rows, ["symbol", *HEADERS])

    narrow_batches(pages.sparkSession)
    return pages.select("symbol", "html").mapInPandas(parse, "symbol string, " + OHLCV_RAW)


# The columns of a market-watch page in their order, the name last.
WATCH = ("symbol", "sector_code", "indices", "ldcp", "open", "high", "low", "price", "change", "change_class", "change_pct", "volume", "name")


def market_watch_parsed(pages: DataFrame) -> DataFrame:
    """All table rows of market-watch pages (html, scraped_at) as quotes, with ``reason`` why a
    row is rejected, null for a good one: ``cells`` for fewer than eleven, ``symbol`` for none;
    and ``texts``, a rejected row's cells. Numbers come from ``data-order``."""

    def number(cell: tuple[str, dict, str]) -> str | None:
        return cell[1].get("data-order")

    def quotes(frame: pd.DataFrame) -> Iterator[tuple]:
        for html, at in zip(frame["html"], frame["scraped_at"]):
            for r in cells(html):
                symbol = number(r[0]) or r[0][0]
                reason = "cells" if len(r) < 11 else None if symbol else "symbol"
                if reason:
                    yield (symbol, *(None,) * (len(WATCH) - 1), at, reason, [c[0] for c in r])
                    continue
                yield (symbol, r[1][0], r[2][0], *(number(c) for c in r[3:8]), number(r[8]), r[8][2], number(r[9]), number(r[10]), r[0][1].get("data-title"), at, None, None)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from frames_of(quotes(frame), [*WATCH, "scraped_at", "reason", "texts"])

    narrow_batches(pages.sparkSession)
    raw = pages.select("html", "scraped_at").mapInPandas(parse, ", ".join(f"{c} string" for c in WATCH) + ", scraped_at timestamp, reason string, texts array<string>")
    typed = {c: S.strict_double(F.col(c)) for c in ("ldcp", "open", "high", "low", "price", "change", "change_pct")}
    typed |= {"volume": S.strict_double(F.col("volume")).cast("bigint"), "indices": S.index_list(F.col("indices")), "change_direction": S.direction(F.col("change_class"))}
    return raw.withColumns(typed).drop("change_class")


def market_watch_rows(pages: DataFrame) -> DataFrame:
    """The good rows of market-watch pages."""
    return good_rows(market_watch_parsed(pages))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason is null").drop("reason", "texts")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """(symbol, scraped_at, reason, texts) of the rejected ones."""
    return parsed.where("reason is not null").select("symbol", "scraped_at", "reason", "texts")


class Element:
    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.inside = tag, attributes, []
        self.classes = set((attributes.get("class") or "").split())

    def every(self, css: str | None = None, tag: str | None = None, **attributes: str) -> Iterator[Element]:
        """Elements inside, in the page's order, that have the class, tag and attributes
        (``data_name`` for ``data-name``), however deep they are."""
        left = self.inside[::-1]
        while left:
            x = left.pop()
            if isinstance(x, Element):
                wanted = all(x.attributes.get(k.replace("_", "-")) == v for k, v in attributes.items())
                if wanted and (css is None or css in x.classes) and (tag is None or x.tag == tag):
                    yield x
                left += x.inside[::-1]

    def first(self, css: str | None = None, tag: str | None = None, **attributes: str) -> Element | None:
        return next(self.every(css, tag, **attributes), None)

    def text(self, between: str = "") -> str:
        left, found = self.inside[::-1], []
        while left:
            x = left.pop()
            if isinstance(x, str):
                found.append(x)
            else:
                left += x.inside[::-1]
        return between.join(found)


class Tree(HTMLParser):
    """Elements in each other. An end without a beginning is left out; an end closes what
    is still open inside it."""

    # Elements without an end.
    EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, html: str | None) -> None:
        super().__init__()
        self.open = [Element("", {})]
        self.tags: Counter[str] = Counter()
        if is_plain(html or ""):
            for _ in feed_plain(self, html or ""):
                pass
        else:
            self.feed(html or "")
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        element = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].inside.append(element)
        if tag not in self.EMPTY:
            self.open.append(element)
            self.tags[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].inside.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        if self.tags[tag]:
            ended = None
            while ended != tag:
                ended = self.open.pop().tag
                self.tags[ended] -= 1

    def handle_data(self, data: str) -> None:
        self.open[-1].inside.append(data)


def tidy(text: str) -> str:
    return text.strip().replace("\u00a0", "").replace("\u2013", "-").replace("\u2014", "-")


def panel_stats(panel: Element | None) -> dict[str, str]:
    """Label -> value of a panel's items; of equal labels, the last."""
    found = {}
    for item in panel.every("stats_item") if panel else ():
        label, value = item.first("stats_label"), item.first("stats_value")
        if label and value:
            found[tidy(label.text())] = tidy(value.text(" "))
    return found


def range_texts(panel: Element | None, word: str) -> tuple[str | None, str | None]:
    """Low and high of the range whose label holds ``word``: from its data attributes, else
    the two parts of its text."""
    held = panel.first("company__quote__rangeStats") if panel else None
    out: tuple[str | None, str | None] = (None, None)
    for item in held.every("stats_item") if held else ():
        label, value = item.first("stats_label"), item.first("stats_value")
        if label and value and word in tidy(label.text()).upper():
            marked = value.first("numRange")
            parts = [marked.attributes.get("data-low"), marked.attributes.get("data-high")] if marked else tidy(value.text(" ")).split("-")
            out = (parts[0], parts[1]) if len(parts) == 2 else (None, None)
    return out


# Labels of a company page's panel and the fields they fill.
QUOTE_LABELS = {
    "Open": "open", "High": "high", "Low": "low", "LDCP": "ldcp", "VAR": "var", "HAIRCUT": "haircut", "P/E Ratio (TTM) **": "pe_ratio_ttm",
    "Ask Price": "ask_price", "Bid Price": "bid_price",
}
QUOTE_COUNTS = {"Volume": "volume", "Ask Volume": "ask_volume", "Bid Volume": "bid_volume"}
PANEL = "REG"
_RANGES = {"circuit_breaker": "CIRCUIT", "day_range": "DAY RANGE"}
_TEXTS = ("name", "sector", "price", "change", "change_pct", "change_direction", "as_of", *QUOTE_LABELS.values(), *QUOTE_COUNTS.values(), *(f"{r}_{side}" for r in _RANGES for side in ("low", "high")))


def quote_texts(html: str | None) -> dict[str, str | None] | None:
    """The texts of a company page's quote, from its section and that section's ``PANEL``
    only; none without a section."""
    section = Tree(html).open[0].first("company__quote")
    if section is None:
        return None
    shown = lambda css: tidy(x.text()) if (x := section.first(css)) else None
    panel = section.first("tabs__panel", data_name=PANEL)
    stats = panel_stats(panel)
    out: dict[str, str | None] = {field: stats.get(label) for label, field in (QUOTE_LABELS | QUOTE_COUNTS).items()}
    for name, word in _RANGES.items():
        out[f"{name}_low"], out[f"{name}_high"] = range_texts(panel, word)
    sector = section.first("quote__sector")
    sector = sector.first(tag="span") if sector else None
    change = section.first("quote__change")
    return out | {
        "name": shown("quote__name"), "sector": tidy(sector.text()) if sector else None, "price": shown("quote__close"), "change": shown("change__value"),
        "change_pct": shown("change__percent"), "as_of": x.text() if (x := section.first("quote__date")) else None,
        "change_direction": "up" if change and "change__text--pos" in change.classes else "down",
    }


def stats_maps(pages: DataFrame) -> DataFrame:
    """(symbol, stats map<string,string>) of company pages (symbol, html): label -> value of
    the ``PANEL``."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            panels = [Tree(html).open[0].first("tabs__panel", data_name=PANEL) for html in frame["html"]]
            yield pd.DataFrame({"symbol": frame["symbol"], "entries": [[{"k": k, "v": v} for k, v in panel_stats(p).items()] for p in panels]})

    narrow_batches(pages.sparkSession)
    raw = pages.select("symbol", "html").mapInPandas(parse, "symbol string, entries array<struct<k:string,v:string>>")
    return raw.select("symbol", F.map_from_entries("entries").alias("stats"))


def company_quotes(pages: DataFrame) -> DataFrame:
    """QUOTE rows of company pages (symbol, html, scraped_at and perhaps url), one a page;
    pages without a quote section are left out. Symbols are trimmed and in upper case."""
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(s, at, u, *(found[c] for c in _TEXTS)) for s, h, at, u in frame.itertuples(index=False, name=None) if (found := quote_texts(h)) is not None]
            yield pd.DataFrame(rows, columns=["symbol", "scraped_at", "source_url", *_TEXTS])

    narrow_batches(pages.sparkSession)
    held = pages.select("symbol", "html", "scraped_at", url.alias("source_url"))
    raw = held.mapInPandas(parse, "symbol string, scraped_at timestamp, source_url string, " + ", ".join(f"{c} string" for c in _TEXTS))
    doubles = {"change", "change_pct", *QUOTE_LABELS.values(), *(f"{r}_{side}" for r in _RANGES for side in ("low", "high"))}
    out = {c: S.loose_double(F.col(c)) for c in doubles} | {c: S.loose_int(F.col(c)) for c in QUOTE_COUNTS.values()}
    out |= {"symbol": F.upper(F.trim("symbol")), "price": S.loose_double(F.regexp_replace("price", r"^Rs\.", "")), "name": S.without_delisted(F.col("name")), "as_of": S.as_of(F.col("as_of"))}
    fields = [f.split(" ")[0] for f in QUOTE.split(", ")]
    return raw.withColumns(out).select(*fields)


def page_titles(pages: DataFrame) -> DataFrame:
    """(page_id, title, n_links): plain patterns, no parser needed."""
    html = F.col("html")
    return pages.select("page_id", F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit("")).alias("title"), F.regexp_count(html, F.lit("<a ")).cast("bigint").alias("n_links"))
