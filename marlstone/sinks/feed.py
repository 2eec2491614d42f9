"""RSS output: the newest events by first sight."""

from __future__ import annotations

import datetime as dt
from email.utils import format_datetime
from pathlib import Path
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import ordered_distinct
from marlstone.functions.times import all_day_text, event_date_text
from marlstone.sinks.calendar import InvalidArtifact, body, link, summary, with_space
from marlstone.sinks.files import write_atomic

LIMIT = 200


def first_seen(events: DataFrame, history: DataFrame, default: Column) -> DataFrame:
    """events with seen_at: the history's first sight, else the event's, else default."""
    old = history.select("uid", F.col("first_seen").alias("_stored"))
    return events.join(old, "uid", "left").withColumn("seen_at", F.coalesce("_stored", "first_seen", default)).drop("_stored")


def newest(events: DataFrame, limit: int = LIMIT, seen: str = "seen_at", key: str = "uid") -> DataFrame:
    return events.orderBy(F.desc(seen), key).limit(limit)


def left_out(events: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row: how many events the feed holds and how many older ones it leaves out."""
    n = F.count("*")
    return events.agg(F.least(n, F.lit(limit)).cast("long").alias("listed"), F.greatest(n - limit, F.lit(0)).cast("long").alias("left_out"))


def date_text() -> Column:
    days = F.concat(all_day_text(F.coalesce("start_date", F.to_date("start_utc")), F.coalesce("end_date", "start_date", F.to_date("start_utc"))), F.lit(" (all day)"))
    return F.when(F.col("all_day"), days).otherwise(event_date_text(F.col("start_utc"), F.col("tz")))


def rendered(events: DataFrame, spaces: DataFrame) -> DataFrame:
    text = body(F.coalesce("summary_line", "description"), date_text())
    return with_space(events, spaces).select("uid", "seen_at", summary().alias("title"), link().alias("link"), text.alias("description"), ordered_distinct(F.col("categories")).alias("categories"))


def validate(data: bytes, expected: int) -> int:
    try:
        items = ElementTree.fromstring(data).findall("./channel/item")
    except ElementTree.ParseError as error:
        raise InvalidArtifact(f"the feed does not parse: {error}") from error
    from email.utils import parsedate_to_datetime

    guids, dates = [i.findtext("guid") for i in items], [parsedate_to_datetime(i.findtext("pubDate")) for i in items]
    if len(items) != expected:
        raise InvalidArtifact(f"{len(items)} items, expected {expected}")
    if None in guids or len(set(guids)) < len(guids):
        raise InvalidArtifact("guids are missing or repeat")
    if dates != sorted(dates, reverse=True):
        raise InvalidArtifact("items are not newest first")
    return len(items)


def emit(events: DataFrame, spaces: DataFrame, out: str | Path, now: dt.datetime, title: str = "Events", home: str = "https://example.org/", limit: int = LIMIT) -> Path:
    """Write events.rss of events that have seen_at; at most limit items reach the driver."""
    rows = newest(rendered(events, spaces), limit).collect()
    mail = lambda x: format_datetime(x if x.tzinfo else x.replace(tzinfo=dt.timezone.utc))
    tag = lambda name, text, attrs="": f"<{name}{attrs}>{escape(text or '')}</{name}>"
    items = ["<item>" + tag("title", r["title"]) + tag("link", r["link"]) + tag("guid", r["uid"], ' isPermaLink="false"') + tag("description", r["description"]) + tag("pubDate", mail(r["seen_at"])) + "".join(tag("category", c) for c in r["categories"]) + "</item>" for r in rows]
    head = tag("title", title) + tag("link", home) + tag("description", title) + tag("language", "en") + tag("lastBuildDate", mail(now))
    data = f'<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel>{head}{"".join(items)}</channel></rss>\n'.encode()
    validate(data, len(rows))
    path = Path(out) / "events.rss"
    write_atomic(path, data)
    return path
