"""Announcements, dividends, bonuses and their audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

FACE_VALUE = 10.0


FEED_ORDER = "_pos"  # a record's place in its feed, where the reader was asked for it


def announcement_outcomes(records: DataFrame) -> DataFrame:
    """All records (raw: map<string,string>) as ANNOUNCEMENT rows with ``reason`` why one is
    rejected, null for a good one: ``null`` if a key is there with a null, else ``symbol``,
    ``date`` or ``kind`` for what is missing. An absent key is empty text."""
    keys = ("company_code", "company_name", "bm_dividend", "bm_bonus", "bm_right_per", "bm_bc_exp", "sector_name")
    null_value = F.lit(False)
    for key in keys:
        null_value = null_value | (F.map_contains_key("raw", key) & F.col("raw")[key].isNull())
    text = {k: F.trim(F.coalesce(F.try_element_at("raw", F.lit(k)), F.lit(""))) for k in keys}
    kinds = [("dividend", "bm_dividend"), ("bonus", "bm_bonus"), ("right", "bm_right_per")]
    types = F.array_compact(F.array(*[F.when(text[k] != "", name) for name, k in kinds]))
    out = records.select(
        text["company_code"].alias("symbol"), text["company_name"].alias("name"), S.percentage(text["bm_dividend"]).alias("dividend"),
        text["bm_bonus"].alias("bonus"), text["bm_right_per"].alias("right"), S.parse_date(text["bm_bc_exp"]).alias("x_date"),
        text["sector_name"].alias("sector"), types.alias("announcement_type"), *[c for c in (FEED_ORDER,) if c in records.columns], null_value.alias("_null"),
    )
    reason = F.when(F.col("_null"), "null").when(F.col("symbol") == "", "symbol").when(F.col("x_date").isNull(), "date").when(F.size("announcement_type") == 0, "kind")
    return out.withColumn("reason", reason).drop("_null")


def parse_announcements(records: DataFrame) -> DataFrame:
    """The good ANNOUNCEMENT rows of records (raw: map<string,string>)."""
    return announcement_outcomes(records).where("reason is null").drop("reason")


def face_value(stocks: DataFrame) -> DataFrame:
    """One row a symbol; of several, the greatest face value."""
    return stocks.groupBy("symbol").agg(F.max("faceValue").alias("_face"))


def active(stocks: DataFrame) -> DataFrame:
    return stocks.where(F.coalesce("isActive", F.lit(False)))


def dividends(announcements: DataFrame, stocks: DataFrame) -> DataFrame:
    """(symbol, exDate, payDate, faceValue, amountPerShare) of the announced dividends above 0."""
    rows = announcements.where(F.array_contains("announcement_type", "dividend") & (F.col("dividend") > 0))
    face = F.coalesce("_face", F.lit(FACE_VALUE))
    joined = rows.join(face_value(stocks), "symbol", "left")
    return joined.select("symbol", F.col("x_date").alias("exDate"), F.col("x_date").alias("payDate"), face.alias("faceValue"), (F.col("dividend") * face / 100).alias("amountPerShare"), *[c for c in (FEED_ORDER,) if c in rows.columns])


def bonuses(announcements: DataFrame) -> DataFrame:
    """(symbol, exDate, bonusPercentage, bonusType) of the announced bonuses above 0."""
    rows = announcements.where(F.array_contains("announcement_type", "bonus")).withColumn("bonusPercentage", S.percentage(F.col("bonus")))
    return rows.where("bonusPercentage > 0").select("symbol", F.col("x_date").alias("exDate"), "bonusPercentage", F.lit("BONUS_SHARES").alias("bonusType"))


def breakdown(announcements: DataFrame) -> DataFrame:
    """One row: counts by kind, first and last date, least and greatest dividend."""
    counts = [F.count_if(F.array_contains("announcement_type", k)).alias(f"n_{k}") for k in ("dividend", "bonus", "right")]
    return announcements.agg(F.count("*").alias("n"), *counts, F.min("x_date").alias("first_date"), F.max("x_date").alias("last_date"), F.min("dividend").alias("min_dividend"), F.max("dividend").alias("max_dividend"))


def collection_stats(dividend_rows: DataFrame, bonus_rows: DataFrame) -> DataFrame:
    """One row: numbers of dividends and bonuses, first and last ex-date of the dividends."""
    of_dividends = dividend_rows.agg(F.count("*").alias("n_dividends"), F.min("exDate").alias("earliest"), F.max("exDate").alias("latest"))
    return of_dividends.join(bonus_rows.agg(F.count("*").alias("n_bonuses")))


ERA_DAYS = 1024


def nearest_match(records: DataFrame, stored: DataFrame, tolerance_days: int) -> DataFrame:
    """``records`` (rid, symbol, exDate, ...) with the stored row (symbol, exDate, amount)
    nearest in time within the tolerance, the earlier on a tie, the smaller amount on one day:
    db_date, db_amount, date_diff, or null.

    Records and stored rows are put into one order a symbol; each record sees the last stored
    row before it and the first one after it. A symbol's years are parted into eras, so that
    one with many rows is not one task's; only stored rows near an era's ends are in two."""
    era_days = max(ERA_DAYS, 4 * tolerance_days)
    day = F.datediff(F.col("exDate"), F.lit("1970-01-01").cast("date"))
    era = lambda d: F.floor(d / era_days)
    held = stored.where("symbol is not null and exDate is not null").groupBy("symbol", "exDate").agg(F.min("amount").alias("db_amount"))
    near = F.array_distinct(F.array(era(day - tolerance_days), era(day), era(day + tolerance_days)))
    right = held.select("symbol", F.explode(near).alias("_era"), F.col("exDate").alias("_at"), F.struct(F.col("exDate").alias("db_date"), "db_amount").alias("_held"))
    packed = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    left = records.select(F.col("symbol"), era(day).alias("_era"), F.col("exDate").alias("_at"), packed.alias("_record"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = Window.partitionBy("symbol", "_era").orderBy(F.col("_at"), F.col("_record").isNotNull())
    before = F.last("_held", True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("_held", True).over(order.rowsBetween(0, Window.unboundedFollowing))
    seen = both.select("_record", "_at", before.alias("_before"), after.alias("_after")).where("_record is not null")
    choice = lambda c: F.when(F.abs(F.datediff(f"{c}.db_date", "_at")) <= tolerance_days, F.struct(F.abs(F.datediff(f"{c}.db_date", "_at")).alias("date_diff"), f"{c}.db_date", f"{c}.db_amount"))
    best = seen.withColumn("_b", F.least(choice("_before"), choice("_after")))
    return best.select(*[F.col(f"_record.`{c}`").alias(c) for c in records.columns], "_b.db_date", "_b.db_amount", "_b.date_diff")


def audit(records: DataFrame, stored: DataFrame, tolerance_days: int = 0, amount_tolerance: float = 0.0) -> DataFrame:
    """``records`` (rid, symbol, exDate, amount) with status: missing, or discrepancy if the
    amounts differ by the tolerance or more (so always at 0), else ok."""
    matched = nearest_match(records, stored, tolerance_days)
    difference = F.abs(F.col("amount") - F.col("db_amount"))
    status = F.when(F.col("db_date").isNull(), "missing").when(difference >= amount_tolerance, "discrepancy").otherwise("ok")
    return matched.withColumn("amount_diff", difference).withColumn("status", status)


def audit_records(raw: DataFrame, stocks: DataFrame, audited: DataFrame | None = None) -> DataFrame:
    """Records to audit of raw rows (rid, symbol, date_text, dividend_text): symbols among the
    audited, percentage above 0 before a parenthesis, a date that parses; face values of
    active stocks only."""
    rows = raw if audited is None else raw.join(audited.select("symbol").distinct(), "symbol", "left_semi")
    percent = S.audit_percentage(F.col("dividend_text"))
    known = rows.withColumns({"exDate": S.parse_date(F.col("date_text")), "_percent": percent}).where("exDate is not null and _percent <> 0")
    joined = known.join(face_value(active(stocks)), "symbol", "left")
    return joined.select("rid", "symbol", "exDate", S.expected_amount(F.col("_percent"), F.coalesce("_face", F.lit(FACE_VALUE))).alias("amount"))


def audit_summary(audited: DataFrame, records: DataFrame, tolerance_days: int, amount_tolerance: float) -> DataFrame:
    """One row of counts over the audited and all ``records``."""
    counts = audited.agg(
        F.count("*").alias("processed_records"), F.countDistinct("symbol").alias("audited_stocks_count"),
        F.count_if(F.col("status") == "missing").alias("missing_in_db_count"), F.count_if(F.col("status") == "discrepancy").alias("discrepancies_count"),
    ).join(records.agg(F.count("*").alias("total_json_records")))
    return counts.withColumns({"skipped_records": F.col("total_json_records") - F.col("processed_records"), "date_tolerance_days": F.lit(tolerance_days), "amount_tolerance": F.lit(amount_tolerance)})
