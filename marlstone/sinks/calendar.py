"""iCalendar output: one VEVENT text per event, one calendar for all and one per space."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.identity import stamp
from marlstone.functions.text import truncated
from marlstone.sinks.files import write_atomic

DESCRIPTION_LIMIT = 300
REQUIRED, FORBIDDEN = ("UID", "DTSTAMP", "DTSTART", "SUMMARY"), ("RRULE", "RDATE", "EXDATE", "RECURRENCE-ID")


class InvalidArtifact(ValueError):
    pass


def with_space(events: DataFrame, spaces: DataFrame) -> DataFrame:
    """events with space_name and space_url; an event of an unknown space fails the run."""
    known = F.broadcast(spaces.select("space_id", F.col("name").alias("space_name"), F.col("url").alias("space_url")))
    out = events.join(known, "space_id", "left")
    return out.withColumn("space_name", F.coalesce("space_name", F.raise_error(F.concat(F.lit("unknown space "), F.col("space_id"))).cast("string")))


def link() -> Column:
    return F.coalesce(F.nullif("url", F.lit("")), F.col("space_url"), F.lit(""))


def summary() -> Column:
    return F.concat(F.lit("["), F.col("space_name"), F.lit("] "), F.coalesce(F.nullif("title", F.lit("")), F.lit("Event")))


def body(text: Column, *lines: Column, limit: int = DESCRIPTION_LIMIT) -> Column:
    """The shortened text, a blank line, then further lines, the price and the attribution."""
    price = F.when(F.coalesce("price", F.lit("")) != "", F.concat(F.lit("Price: "), F.col("price")))
    credit = F.when(link() != "", F.concat(F.col("space_name"), F.lit(" — "), link())).otherwise(F.col("space_name"))
    return F.concat_ws("\n\n", F.nullif(truncated(text, limit), F.lit("")), F.concat_ws("\n", *lines, price, credit))


def escaped(c: Column) -> Column:
    c = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit(";"), F.lit("\\;")), F.lit(","), F.lit("\\,"))
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\\n")), F.lit("\n"), F.lit("\\n"))


def folded(line: Column) -> Column:
    """Lines of at most 75 bytes: blocks of 24 characters of up to three bytes, or fewer of four, continued with a space."""
    return F.when(F.octet_length(line) <= 75, line).otherwise(F.regexp_replace(line, r"(?s)(.{18})(?=.)", "$1\r\n "))


def vevent(dtstamp: Column) -> Column:
    """The VEVENT text of an event that with_space() has prepared."""
    day = lambda c: F.date_format(c, "yyyyMMdd")
    prop = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", folded(F.concat(F.lit(f"{name}:"), value)))
    first = F.coalesce(F.col("start_date"), F.to_date("start_utc"))
    last = F.coalesce(F.col("end_date"), first)
    begin = F.when(F.col("all_day"), F.concat(F.lit("DTSTART;VALUE=DATE:"), day(first))).otherwise(F.concat(F.lit("DTSTART:"), stamp(F.col("start_utc"))))
    end = F.when(F.col("all_day"), F.concat(F.lit("DTEND;VALUE=DATE:"), day(F.date_add(last, 1)))).when(F.col("end_utc").isNotNull(), F.concat(F.lit("DTEND:"), stamp(F.col("end_utc"))))
    organizer = F.concat(F.lit('ORGANIZER;CN="'), F.replace("space_name", F.lit('"'), F.lit("'")), F.lit('":'), F.coalesce("space_url", F.lit("")))
    lines = [
        F.lit("BEGIN:VEVENT"), prop("UID", F.col("uid")), F.concat(F.lit("DTSTAMP:"), stamp(dtstamp)), begin, end, prop("SUMMARY", escaped(summary())), prop("DESCRIPTION", escaped(body(F.col("description")))),
        prop("LOCATION", escaped(F.coalesce(F.nullif("address", F.lit("")), F.col("location_name")))), prop("URL", link()), folded(organizer), prop("CATEGORIES", F.array_join(F.transform("categories", escaped), ",")),
        prop("X-SPACE-ID", F.col("space_id")), prop("X-SOURCE", F.col("source_label")), F.lit("END:VEVENT"),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n"))


def rendered(events: DataFrame, spaces: DataFrame, now: Column) -> DataFrame:
    return with_space(events, spaces).withColumn("vevent", vevent(now))


def calendar_text(rows: list[str], name: str, zone: str) -> bytes:
    head = ["BEGIN:VCALENDAR", "PRODID:-//marlstone//events//EN", "VERSION:2.0", "CALSCALE:GREGORIAN", "METHOD:PUBLISH", f"X-WR-CALNAME:{name}", f"X-WR-TIMEZONE:{zone}"]
    return ("\r\n".join(head) + "\r\n" + "".join(rows) + "END:VCALENDAR\r\n").encode()


def validate(data: bytes, expected: int, tolerance: int = 0) -> int:
    """Read a calendar back: counts, required and forbidden properties, unique uids, aware times, exclusive all-day ends."""
    from marlstone.sources.ics import components, moment

    text = data.decode()
    if "BEGIN:VCALENDAR" not in text:
        raise InvalidArtifact("not a calendar")
    own, *parts = components(text)
    if not {"PRODID", "VERSION"} <= {n for n, _, _ in own[1]}:
        raise InvalidArtifact("the calendar has no PRODID or VERSION")
    events = [props for kind, props in parts if kind == "VEVENT"]
    if abs(len(events) - expected) > tolerance:
        raise InvalidArtifact(f"{len(events)} events, expected {expected}")
    seen: set[str] = set()
    for props in events:
        by = {n: (p, v) for n, p, v in props}
        if missing := [n for n in REQUIRED if not by.get(n, ({}, ""))[1]]:
            raise InvalidArtifact(f"an event lacks {missing[0]}")
        if extra := [n for n in FORBIDDEN if n in by]:
            raise InvalidArtifact(f"an event carries {extra[0]}")
        uid = by["UID"][1]
        if uid in seen:
            raise InvalidArtifact(f"uid {uid} repeats")
        seen.add(uid)
        start, form, _ = moment(by["DTSTART"][1], by["DTSTART"][0])
        if start is None or form == "floating":
            raise InvalidArtifact(f"{uid}: DTSTART is not aware")
        if form == "date":
            end = moment(by["DTEND"][1], by["DTEND"][0])[0] if "DTEND" in by else None
            if by["DTSTART"][0].get("VALUE") != "DATE" or (end is not None and not end > start):
                raise InvalidArtifact(f"{uid}: all-day ends are exclusive")
    return len(events)


def repeated(events: DataFrame, key: str = "uid") -> DataFrame:
    """(uid, n) of uids that occur more than once: what validation names when it refuses a set."""
    return events.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def emit(events: DataFrame, spaces: DataFrame, out: str | Path, now: dt.datetime, name: str = "Events", zone: str = "America/Los_Angeles") -> list[Path]:
    """Write events.ics and <space>.ics; everything is rendered and validated before the first file is touched.

    A calendar is one text, so its events meet on the driver: the published set, bounded by horizon and registry.
    """
    rows = rendered(events, spaces, F.lit(now)).orderBy("start_utc", "uid").select("space_id", "vevent").collect()
    plans = [(Path(out) / "events.ics", [r["vevent"] for r in rows])]
    plans += [(Path(out) / f"{s}.ics", [r["vevent"] for r in rows if r["space_id"] == s]) for s in sorted({r["space_id"] for r in rows})]
    ready = [(path, calendar_text(texts, name, zone), len(texts)) for path, texts in plans]
    for _, data, n in ready:
        validate(data, n)
    for path, data, _ in ready:
        write_atomic(path, data)
    return [path for path, _, _ in ready]
