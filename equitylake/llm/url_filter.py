"""URL filter: a blocked Bloom filter of listed canonical URLs before an exact join.

The filter is a table: ``bucket`` and ``LANES`` 64-bit words, one bit of each word set by
each listed URL, so that a look-up touches one row. A filter of at most ``BROADCAST_BYTES``
goes to every task, and URLs are tested where they are read, before any shuffle; a larger one
is joined by bucket. URLs with all bits set are possible hits, and only they are joined
exactly with the list, which removes the false positives. Everything is a DataFrame function.

Canonical form: scheme dropped; host lower-cased, without port, user and a leading
``www.`` or ``m.``; path without ``index.html``/``.html`` at its end and without trailing
slashes; query and fragment dropped.

Rules (host, path, verdict) come first: a rule fits its host and all subdomains if the
path starts with the rule's; the longest rule wins. Elsewhere a listed URL is blocked.

Defined results: null or scheme-less URL: empty host and path, no rule, allowed. Rows
with equal or null ``page_id`` are kept; other columns are dropped by ``judge``. Equal
listed URLs count once; nulls in the list are left out; an empty list blocks nothing.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

LANES = 8
BROADCAST_BYTES = 64_000_000
URLS_A_BUCKET = 16  # of 512 bits: about 1 % false positives
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"^(www|m)\.", "")
    return F.concat(plain, F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), r"/+$", ""))


def bucket_of(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets))


def bits_of(url: Column) -> list[Column]:
    """One bit for each lane, six bits of a second hash apiece."""
    second = F.xxhash64(F.lit("lane"), url)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(LANES)]


def bloom_filter(listed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, lane0 ...) of the list (url: canonical, distinct)."""
    lanes = [F.bit_or(b).alias(f"lane{k}") for k, b in enumerate(bits_of(F.col("url")))]
    return listed.groupBy(bucket_of(F.col("url"), buckets).alias("bucket")).agg(*lanes)


def filtered(urls: DataFrame, listed: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``urls`` (url, ...) with ``possible``: whether the filter of the list (url: distinct) lets
    a URL pass. A filter of at most ``most_bytes``, by its counted buckets, goes to every task,
    so that URLs are not shuffled; beyond that both meet by bucket."""
    buckets = listed.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / URLS_A_BUCKET)).cast("long").alias("n")).first()["n"]
    table = bloom_filter(listed, buckets)
    keyed = urls.withColumn("bucket", bucket_of(F.col("url"), buckets))
    joined = keyed.join(F.broadcast(table) if buckets * (LANES + 1) * 8 <= most_bytes else table, "bucket", "left")
    held = functools.reduce(Column.__and__, [F.col(f"lane{k}").bitwiseAND(b) == b for k, b in enumerate(bits_of(F.col("url")))])
    return joined.select(*urls.columns, F.coalesce(held, F.lit(False)).alias("possible"))


def with_hits(urls: DataFrame, listed: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``urls`` (url, ...) with ``hit``: whether the list (url) holds a URL; both canonical. Only
    possible hits are joined with the list; the rest is done where it was read."""
    wanted = listed.where("url is not null").distinct()
    tested = filtered(urls, wanted, most_bytes)
    found = tested.where("possible").join(wanted.withColumn("hit", F.lit(True)), "url", "left")
    missed = tested.where("not possible").withColumn("hit", F.lit(False))
    return found.withColumn("hit", F.coalesce("hit", F.lit(False))).select(*urls.columns, "hit").unionByName(missed.select(*urls.columns, "hit"))


def listed_urls(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct ``url`` of ``urls`` that the list (url) holds; both canonical."""
    return with_hits(urls.select("url"), listed).where("hit").select("url").distinct()


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The rule that wins and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of pages (page_id, url); ``listed`` (url) is canonical."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("*", rule.alias("rule"), says.alias("says"), canonical(F.col("host"), F.col("path")).alias("url"))
    columns = ("page_id", "host", "path", "rule")
    # Neither pages with a rule nor those without a URL are looked up.
    asked = with_hits(ruled.where("rule is null and url <> ''"), listed).select(*columns, F.when(F.col("hit"), "block").otherwise("allow").alias("verdict"))
    rest = ruled.where("rule is not null or url = ''").select(*columns, F.coalesce("says", F.lit("allow")).alias("verdict"))
    return asked.unionByName(rest)


def adult_list(pages: DataFrame) -> DataFrame:
    """The list of the query: canonical URLs of all pages on hosts with a label ``adult...``."""
    parts = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.where(F.col("host").rlike(r"(^|\.)adult")).select(canonical(F.col("host"), F.col("path")).alias("url")).distinct()


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, adult_list(pages))


OP10_SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)?', 1), '') AS path
  FROM pages
), plain AS (
  SELECT *,
    regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '^(www|m)\.', '')
      || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') AS url,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts
), listed AS (
  SELECT DISTINCT url FROM plain WHERE regexp_matches(host, '(^|\.)adult')
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN url <> '' AND url IN (SELECT url FROM listed) THEN 'block'
       ELSE 'allow' END AS verdict
FROM plain
"""
