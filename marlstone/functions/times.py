"""Zones, day anchors and human dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utc(local: Column, zone: Column) -> Column:
    """Wall clock in zone to an instant; of a repeated hour the first, of a skipped one the later reading."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def local_time(instant: Column, zone: Column) -> Column:
    return F.from_utc_timestamp(instant, zone)


def day_start_utc(day: Column, zone: Column) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def local_day(instant: Column, zone: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def event_date_text(start: Column, zone: Column) -> Column:
    """Friday, March 6, 2026, 7:30 PM"""
    return F.concat(F.date_format(local_time(start, zone), "EEEE, MMMM d, yyyy"), F.lit(", "), F.date_format(local_time(start, zone), "h:mm a"))


def all_day_text(first: Column, last: Column) -> Column:
    day = lambda c: F.date_format(c, "EEEE, MMMM d, yyyy")
    return F.when(first == last, day(first)).otherwise(F.concat(day(first), F.lit(" – "), day(last)))


def offset_text(instant: Column, zone: Column) -> Column:
    """The offset of a zone at an instant, as +HH:MM or -HH:MM."""
    minutes = ((F.unix_timestamp(F.from_utc_timestamp(instant, zone)) - F.unix_timestamp(instant)) / 60).cast("int")
    return F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)


def iso_offset(c: Column) -> Column:
    """The offset that an ISO 8601 time ends in (Z is +00:00), else null."""
    found = F.regexp_extract(c, r"(Z|[+-]\d{2}:?\d{2})$", 1)
    return F.when(found == "Z", "+00:00").when(found != "", F.concat(F.substring(found, 1, 3), F.lit(":"), F.substring(found, -2, 2)))


def epoch_instant(c: Column, millis: bool = False) -> Column:
    """Seconds (or milliseconds) since 1970 within 1990 to 2100; else null."""
    seconds = c.cast("double") / (1000 if millis else 1)
    return F.when(seconds.between(631152000, 4102444800), F.timestamp_seconds(seconds))


def us_short(c: Column) -> Column:
    """MM/dd/yy h:mm AM within 1990 to 2040; else null."""
    at = F.try_to_timestamp(F.upper(F.trim(c)), F.lit("M/d/yy h:mm a"))
    return F.when(F.year(at).between(1990, 2040), at.cast("timestamp_ntz"))


def feed_date(c: Column) -> Column:
    """RFC 822 dates (weekday and zone names allowed), then RFC 3339; else null."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9},\s*", "")
    zoned = F.regexp_replace(F.regexp_replace(bare, r"(?i)\b(GMT|UTC|UT|Z)$", "+0000"), r"\s+", " ")
    for name, offset in (("EST", "-0500"), ("EDT", "-0400"), ("CST", "-0600"), ("CDT", "-0500"), ("MST", "-0700"), ("MDT", "-0600"), ("PST", "-0800"), ("PDT", "-0700")):
        zoned = F.regexp_replace(zoned, rf"\b{name}$", offset)
    return F.coalesce(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm Z")), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")))
