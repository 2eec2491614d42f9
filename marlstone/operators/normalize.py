"""Raw occurrences to canonical events, with a disposition for each.

Nothing is lost: every raw row comes out once, with disposition event,
quarantined or dropped and the reason. The only shuffle is the house-venue
aggregation, whose result (a few rows per source) joins back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.identity import content_hash, make_uid
from marlstone.functions.text import TITLE_LIMIT, clean, is_bare_url, normalize_title
from marlstone.functions.times import day_start_utc, local_day, to_utc

#: Starts further ahead than this are implausible.
FUTURE_DAYS = 730


def house_venues(raws: DataFrame) -> DataFrame:
    """(space_id, source_label, house_key): locations that over half of a source's located events name, as normalized text."""
    text = clean(F.col("location"))
    located = raws.where(text.isNotNull() & ~is_bare_url(text)).select("space_id", "source_label", normalize_title(text).alias("house_key"))
    counts = located.groupBy("space_id", "source_label", "house_key").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("space_id", "source_label"))
    return counts.withColumn("located", total).where(F.col("n") * 2 > F.col("located")).select("space_id", "source_label", "house_key")


def venue(location: Column, override: Column, space_name: Column, house_key: Column) -> Column:
    """struct(address, address_source, off_site): the house address where the location is missing, a URL or the house itself."""
    text, fixed = clean(location), clean(override)
    key, name = normalize_title(text), normalize_title(space_name)
    missing = text.isNull() | F.coalesce(is_bare_url(text), F.lit(False))
    at_home = (key == F.coalesce(house_key, F.lit("\x00"))) | (key == normalize_title(fixed)) | ((name != "") & F.contains(key, name))
    make = lambda address, source, off: F.struct(address.cast("string").alias("address"), F.lit(source).alias("address_source"), F.lit(off).alias("off_site"))
    return (
        F.when(fixed.isNull() & missing, make(F.lit(None), "none", False)).when(fixed.isNull(), make(text, "source", False))
        .when(missing | at_home, make(fixed, "override", False)).otherwise(make(text, "source", True))
    )


def drop_reason(start: Column, all_day: Column, end_date: Column, event_zone: Column, zone: Column, now: Column) -> Column:
    """past (before today in zone; an all-day event lasts through its end date), too_far, or null."""
    floor = day_start_utc(local_day(now, zone), zone)
    over = F.when(all_day & end_date.isNotNull(), day_start_utc(F.date_add(end_date, 1), event_zone) <= floor).otherwise(start < floor)
    return F.when(start.isNull(), "no_start").when(over, "past").when(start > now + F.make_dt_interval(days=F.lit(FUTURE_DAYS)), "too_far")


def quarantine_reason(title: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) == "", "empty_title").when(F.length(title) > TITLE_LIMIT, "title_too_long")


def normalize(raws: DataFrame, spaces: DataFrame, now: Column, calendar_zone: Column | None = None) -> DataFrame:
    """Canonical events of raws (schemas.RAW_EVENT) with disposition and reason.

    Times become instants: aware ones as they are, floating ones read in the
    calendar's zone, else the space's, and flagged tz_assumed; all-day events
    are anchored to midnight in the source's zone. A floating time whose source
    declares a zone is a contradiction: disposition error. Raws of a space that
    is not in spaces fail the run.
    """
    known = F.broadcast(spaces.select("space_id", F.col("name").alias("space_name"), F.col("timezone").alias("zone"), "address_override"))  # the registry's size
    houses = house_venues(raws)
    joined = raws.join(known, "space_id", "left").join(houses, ["space_id", "source_label"], "left")
    zone = F.coalesce(F.col("zone"), F.raise_error(F.concat(F.lit("unknown space "), F.col("space_id"))).cast("string"))
    by_day = F.col("start_date").isNotNull()
    anchor = F.coalesce("source_tz", zone)
    floating = ~by_day & F.col("start_instant").isNull() & F.col("start_local").isNotNull()
    read_in = F.coalesce(calendar_zone, zone) if calendar_zone is not None else zone
    last = F.when(F.col("end_date").isNull() | (F.col("end_date") < F.col("start_date")), F.col("start_date")).otherwise(F.col("end_date"))
    tz = F.when(by_day, anchor).when(floating, read_in).otherwise(F.coalesce("tz", "source_tz", F.lit("UTC")))
    start = F.when(by_day, day_start_utc(F.col("start_date"), anchor)).when(floating, to_utc(F.col("start_local"), read_in)).otherwise(F.col("start_instant"))
    end = F.when(by_day, day_start_utc(F.date_add(last, 1), anchor)).otherwise(F.coalesce(F.col("end_instant"), to_utc(F.col("end_local"), tz)))
    contradiction = floating & (F.col("source_tz").isNotNull() | F.coalesce(F.col("dtstart_form").isin("utc", "tzid"), F.lit(False)))
    timed = joined.withColumns({"zone": zone, "start_utc": start, "end_utc": end, "event_tz": tz, "last_day": F.when(by_day, last), "contradiction": contradiction, "tz_assumed": (by_day & F.col("source_tz").isNull()) | floating, "title": F.coalesce(clean(F.col("title")), F.lit("")), "placed": venue(F.col("location"), F.col("address_override"), F.col("space_name"), F.col("house_key"))})
    events = timed.select(
        make_uid(F.col("space_id"), F.col("source_uid"), F.col("start_utc"), F.col("title"), F.col("recurring")).alias("uid"), "space_id", "source_label", "title", "start_utc", "end_utc", F.col("event_tz").alias("tz"),
        F.coalesce("all_day", F.lit(False)).alias("all_day"), clean(F.col("location")).alias("location_name"), F.col("placed.address").alias("address"), clean(F.col("url")).alias("url"), clean(F.col("price")).alias("price"),
        clean(F.col("description")).alias("description"), F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), F.lit(None).cast("string").alias("summary_line"), F.lit(None).cast("string").alias("rrule"),
        F.lit(None).cast("timestamp").alias("first_seen"), F.lit(None).cast("timestamp").alias("last_seen"), clean(F.col("source_uid")).alias("source_uid"), "dtstart_form", "tz_assumed", F.coalesce("recurring", F.lit(False)).alias("recurring"),
        (F.coalesce("days", F.lit(1)) > 1).alias("multi_day"), F.coalesce("days", F.lit(1)).alias("days"), "start_date", F.col("last_day").alias("end_date"), F.col("placed.address_source").alias("address_source"), F.col("placed.off_site").alias("off_site"), "zone", "contradiction",
    )
    events = events.withColumn("content_hash", content_hash(F.col("title"), F.col("start_utc"), F.col("end_utc"), F.col("location_name"), F.col("address"), F.col("url"), F.col("description")))
    dropped = drop_reason(F.col("start_utc"), F.col("all_day"), F.col("end_date"), F.col("tz"), F.col("zone"), now)
    held = quarantine_reason(F.col("title"))
    disposition = F.when(F.col("contradiction"), "error").when(dropped.isNotNull(), "dropped").when(held.isNotNull(), "quarantined").otherwise("event")
    reason = F.when(F.col("contradiction"), "floating_time_with_zone").otherwise(F.coalesce(dropped, held))
    return events.withColumns({"disposition": disposition, "reason": reason, "quarantine": F.when(dropped.isNull(), held)}).drop("zone", "contradiction")


def day_order() -> list[Column]:
    """Raw events by local day, whole days first, then time and uid."""
    from marlstone.sources.base import day_of

    local = F.coalesce(F.from_utc_timestamp("start_instant", F.coalesce("tz", "source_tz", F.lit("UTC"))).cast("timestamp_ntz"), F.col("start_local"))
    return [day_of(), F.desc(F.coalesce("all_day", F.lit(False))), local, F.col("source_uid")]


def accepted(normalized: DataFrame) -> DataFrame:
    """Publishable events, by start and uid when written."""
    return normalized.where(F.col("disposition") == "event").drop("disposition", "reason")


def collision_floor(events: DataFrame, *order: Column | str) -> DataFrame:
    """One row per uid: the first by order."""
    first = F.row_number().over(Window.partitionBy("uid").orderBy(*order))
    return events.withColumn("_nth", first).where("_nth = 1").drop("_nth")
