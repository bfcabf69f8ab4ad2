"""Readers: files and feeds to typed DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import report_date
from ..schemas import GAP_REPORT, STOCKS, SYMBOL_FEED


def feed_rows(texts: DataFrame) -> DataFrame:
    """Instruments of JSON arrays (value); ``pos`` is their order. Broken texts have none."""
    items = texts.select(F.posexplode(F.from_json("value", f"array<struct<{_struct(SYMBOL_FEED)}>>")).alias("pos", "r"))
    return items.select("pos", "r.*")


def symbol_feed(spark: SparkSession, path: str) -> DataFrame:
    return feed_rows(spark.read.text(path, wholetext=True))


def stored_symbols(stocks: DataFrame) -> DataFrame:
    return stocks.select("symbol").where("symbol is not null").distinct()


def _struct(ddl: str) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (p.strip().split(" ") for p in ddl.split(", ")))


def stocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STOCKS).json(path)


def announcement_records(envelopes: DataFrame, column: str = "value", order: str | None = None) -> DataFrame:
    """(raw map<string,string>) of JSON texts: a list of records, or one under ``d``. A map
    tells an absent key from a null. Other shapes and broken texts have no records. ``order``
    names a column for a record's place in its text."""
    inner = F.get_json_object(F.col(column), "$.d")
    text = F.coalesce(inner, F.col(column))
    found = envelopes.select(F.posexplode(F.from_json(text, "array<map<string,string>>")).alias(order or "_pos", "raw")).where("raw is not null")
    return found if order else found.select("raw")


def announcements(spark: SparkSession, path: str) -> DataFrame:
    return announcement_records(spark.read.text(path, wholetext=True))


def report_rows(texts: DataFrame, kind: str = GAP_REPORT) -> DataFrame:
    """(symbol, start, end, ...) of report texts (value): a map of symbols to their ranges,
    or several, each at the beginning of a line. Broken texts have no rows."""
    parsed = texts.select(F.explode(F.split("value", r'\n(?=\{")')).alias("value")).select(F.from_json("value", kind).alias("m"))
    entries = parsed.select(F.explode("m").alias("symbol", "ranges"))
    rows = entries.select("symbol", F.explode("ranges").alias("g")).select("symbol", "g.*")
    return rows.withColumns({c: report_date(F.col(c)) for c in ("start", "end")})


def gap_report(spark: SparkSession, path: str, kind: str = GAP_REPORT) -> DataFrame:
    """The rows of a report's file or folder; none if there is none. A folder holds lines, a
    map each, and is read line by line; a single file may be one document of many lines."""
    if not exists(spark, path):
        return report_rows(spark.createDataFrame([], "value string"), kind)
    return report_rows(spark.read.text(path, wholetext=not is_folder(spark, path)), kind)


def enriched(records: DataFrame, symbol: str | Column, scraped_at: str | Column) -> DataFrame:
    """Records (raw) with ``_scraped_symbol`` and ``_scraped_at`` put in."""
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v.cast("string")
    more = F.create_map(F.lit("_scraped_symbol"), as_column(symbol), F.lit("_scraped_at"), as_column(scraped_at))
    kept = F.map_filter("raw", lambda k, v: ~k.isin("_scraped_symbol", "_scraped_at"))
    return records.withColumn("raw", F.map_concat(kept, more))


def symbol_dividends(answers: DataFrame, scraped_at: str) -> DataFrame:
    """Enriched records of the answers (symbol, value) to requests for one symbol each; a
    failed answer (null or broken) has none."""
    inner = F.coalesce(F.get_json_object("value", "$.d"), F.col("value"))
    rows = answers.select("symbol", F.explode(F.from_json(inner, "array<map<string,string>>")).alias("raw")).where("raw is not null")
    return enriched(rows, F.col("symbol"), scraped_at).select("raw")


def working_form(answers: DataFrame) -> DataFrame:
    """Of answers (form, value) to several forms of a request, the first with a record."""
    inner = F.coalesce(F.get_json_object("value", "$.d"), F.col("value"))
    n = F.coalesce(F.size(F.from_json(inner, "array<map<string,string>>")), F.lit(0))
    return answers.select("form", n.alias("n")).where("n > 0").agg(F.min(F.struct("form", "n")).alias("a")).where("a is not null").select("a.form", "a.n")


def pages_read(answers: DataFrame) -> DataFrame:
    """Answers (page, n) up to the first page without a record."""
    end = answers.agg(F.min(F.when(F.col("n") == 0, F.col("page"))).alias("_end"))  # one row
    return answers.join(F.broadcast(end)).where("_end is null or page < _end").drop("_end")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop))


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory())


def audit_file(spark: SparkSession, path: str) -> DataFrame:
    """Earlier audit records; none if there is no file yet or it is broken. A folder holds
    lines, each a list of records; a single file may be one list of many lines."""
    if not exists(spark, path):
        return spark.createDataFrame([], "raw map<string,string>")
    return announcement_records(spark.read.text(path, wholetext=not is_folder(spark, path)))


def reachable(spark: SparkSession, path: str) -> tuple[bool, str]:
    """Whether a table's folder is there, and a message."""
    there = exists(spark, path)
    return there, f"{path}: {'found' if there else 'not found'}"


def json_profile(records: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """(key, n, n_null, sample) over records (raw map<string,string>). Expected names that no
    key equals but for case are there with n = 0."""
    entries = records.select(F.explode("raw").alias("key", "value"))
    found = entries.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("n_null"), F.min("value").alias("sample"))
    if not expected:
        return found
    names = records.sparkSession.createDataFrame([(name,) for name in expected], "key string")
    seen = found.select(F.lower("key").alias("_seen"))
    absent = names.join(seen, F.lower("key") == F.col("_seen"), "left_anti")
    return found.unionByName(absent.select("key", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_null"), F.lit(None).cast("string").alias("sample")))
