"""Scalar functions: Column -> Column, all inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date formats that the feeds use, tried in this order.
DATE_FORMATS = ("d MMM yyyy", "d-MMM-yyyy", "d/M/yyyy", "yyyy-M-d", "MMMM d, yyyy", "d MMMM yyyy")
LOCAL_OFFSET = "+05:00"


def parse_date(text: Column) -> Column:
    """The first format that fits; null if none does. Runs of white space count as one."""
    plain = F.regexp_replace(F.trim(text), r"\s+", " ")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def percentage(text: Column) -> Column:
    """Number before a percent sign; 0 for anything else."""
    return F.coalesce(F.trim(F.regexp_replace(text, "%", "")).try_cast("double"), F.lit(0.0))


def audit_percentage(text: Column) -> Column:
    """Like ``percentage``, of what stands before a parenthesis."""
    return percentage(F.substring_index(text, "(", 1))


def expected_amount(percent: Column, face_value: Column) -> Column:
    return F.round(percent / 100 * face_value, 4)


def minor_units(price: Column) -> Column:
    """Hundredths, halves of the binary product to even."""
    return F.rint(price * 100).cast("bigint")


def loose_double(text: Column) -> Column:
    kept = F.regexp_replace(text, r"[^0-9.\-]", "")
    return F.when(kept != "", kept).try_cast("double")


def loose_int(text: Column) -> Column:
    kept = F.regexp_replace(text, r"[^0-9]", "")
    return F.when(kept != "", kept).try_cast("bigint")


def strict_double(text: Column) -> Column:
    return text.try_cast("double")


def clean(text: Column) -> Column:
    """Trimmed, without no-break spaces, dashes plain."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), "\u00a0", ""), "[\u2013\u2014]", "-")


def as_of(text: Column) -> Column:
    """``As of Wed, Jun 24, 2026 3:48 PM`` (local time) as a UTC timestamp."""
    found = F.regexp_extract(text, r"As of \w+, (.+)$", 1)
    local = F.try_to_timestamp(F.regexp_replace(F.trim(found), r"\s+", " "), F.lit("MMM d, yyyy h:mm a"))
    return F.to_utc_timestamp(local, LOCAL_OFFSET)


def low_high(text: Column) -> Column:
    """struct(low, high) of ``411.72 - 503.22``; nulls unless there are exactly two parts."""
    parts = F.split(clean(text), r"\s*-\s*")
    two = F.size(parts) == 2
    return F.struct(F.when(two, loose_double(parts[0])).alias("low"), F.when(two, loose_double(F.try_element_at(parts, F.lit(2)))).alias("high"))


def without_delisted(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, "DELISTED$", ""))


def index_list(text: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def iso_date(text: Column) -> Column:
    """The date of an ISO date or date and time; null for anything else."""
    plain = F.trim(text)
    whole = plain.rlike(r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)?)?$")
    return F.when(whole, F.substring(plain, 1, 10)).try_cast("date")


def report_date(text: Column) -> Column:
    """A report's date, ``yyyy-MM-dd`` and nothing else; other text is an error."""
    return F.to_date(text, "yyyy-MM-dd")


def local_now() -> Column:
    """The present time in the exchange's zone."""
    return F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), LOCAL_OFFSET)


def minute_floor(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def local_date(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, LOCAL_OFFSET).cast("date")


def direction(css_class: Column) -> Column:
    """``up`` only for the positive class; flat counts as down."""
    return F.when(F.coalesce(css_class, F.lit("")).contains("positive"), "up").otherwise("down")


def duration(start: Column, end: Column) -> Column:
    return F.datediff(end, start)
