"""Date functions; the clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import col, strip


def _first(raw: Column, formats: list[str]) -> Column:
    return F.coalesce(*(F.try_to_timestamp(raw, F.lit(f)) for f in formats))


def parse_feed_date(c: Column | str) -> Column:
    """RFC 822 and ISO forms; UTC if there is no zone; null if nothing fits."""
    raw = F.regexp_replace(strip(c), "^[A-Za-z]{3,9},\\s*", "")
    raw = F.regexp_replace(F.regexp_replace(raw, r"\s+(GMT|UTC|UT|Z)$", " +0000"), r"\s+", " ")
    return _first(
        raw,
        [
            "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd",
            "d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm xx", "d MMM yyyy HH:mm:ss", "d MMM yyyy",
        ],
    )


def parse_sheet_date(c: Column | str) -> Column:
    """four-digit years first, then two-digit ones of this century; day before month where both fit. Null if none fits."""
    return _first(strip(c), ["d/M/yyyy", "yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d/M/yy", "M/d/yy", "d-M-yy", "yy-M-d"])


def parse_ordinal_date(c: Column | str) -> Column:
    """``16th April 2026``."""
    plain = F.regexp_replace(strip(c), r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    return F.coalesce(F.try_to_timestamp(plain, F.lit("d MMMM yyyy")), F.try_to_timestamp(plain, F.lit("d MMM yyyy"))).cast("date")


def days_ago(c: Column | str, now: Column, clamp: bool = True, posted: bool = False) -> Column:
    """age in days of an ISO time or of words. ``posted``: words count only after Posted or Reposted."""
    raw = strip(c)
    when = F.try_to_timestamp(F.regexp_replace(raw, "Z$", "+00:00"))
    passed, day = F.unix_micros(now.cast("timestamp")) - F.unix_micros(when), F.lit(86_400_000_000)
    age = F.call_function("div", passed - F.pmod(passed, day), day)
    pattern = r"(?i)(?:Posted|Reposted)\s+(\d+)\s+(hour|day|week|month|year)s?\s+ago" if posted else r"(?i)(\d+)\s*(hour|day|week|month|year)s?\s*ago"
    n = F.nullif(F.regexp_extract(raw, pattern, 1), F.lit("")).cast("bigint")
    unit = F.lower(F.regexp_extract(raw, pattern, 2))
    times = F.when(unit == "hour", 0).when(unit == "day", 1).when(unit == "week", 7).when(unit == "month", 30).when(unit == "year", 365)
    low = F.lower(raw)
    words = F.when(low.isin("just now", "today") & F.lit(not posted), 0).when((low == "yesterday") & F.lit(not posted), 1).otherwise(n * times)
    return F.when(when.isNotNull(), F.greatest(age, F.lit(0)) if clamp else age).otherwise(words).cast("bigint")


def event_date_text(start: Column, end: Column) -> Column:
    """``14-16 May`` for a range, ``Thu 14 May`` for a day, empty if undated."""
    span = F.concat(F.day(start).cast("string"), F.lit("-"), F.day(end).cast("string"), F.lit(" "), F.date_format(start, "MMM"))
    return F.when(start.isNull(), "").when(end.isNotNull() & (end != start), span).otherwise(F.date_format(start, "EEE dd MMM"))


def month_bucket(date: Column) -> Column:
    """``May 2026``, or Unknown date."""
    return F.coalesce(F.date_format(date, "MMMM yyyy"), F.lit("Unknown date"))


def runtime_text(seconds: Column) -> Column:
    """hours, minutes and seconds."""
    s = F.floor(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600).cast("bigint"), F.floor((s % 3600) / 60).cast("bigint"), s % 60
    text = [x.cast("string") for x in (h, m, r)]
    return (
        F.when(h > 0, F.concat(text[0], F.lit("h "), F.lpad(text[1], 2, "0"), F.lit("m "), F.lpad(text[2], 2, "0"), F.lit("s")))
        .when(m > 0, F.concat(text[1], F.lit("m "), F.lpad(text[2], 2, "0"), F.lit("s")))
        .otherwise(F.concat(text[2], F.lit("s")))
    )


def iso_or_null(c: Column | str) -> Column:
    """an ISO time as it is (Z as an offset), or null."""
    fixed = F.regexp_replace(col(c), "Z$", "+00:00")
    return F.when(F.try_to_timestamp(fixed).isNotNull(), fixed)
