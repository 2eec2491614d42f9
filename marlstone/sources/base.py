"""What the readers share: verdict rows, payload guards, the horizon clip and the dispatch table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.functions.text import content_type, content_type_matches
from marlstone.schemas import RAW_EVENT, ddl

VERDICT = ddl("problem string, detail string, has_event boolean, undated boolean, in_horizon boolean, newest_change timestamp")
PARSED = StructType([*RAW_EVENT.fields, *VERDICT.fields])

CALENDAR, JSON, HTML = ["text/calendar", "text/x-vcalendar"], ["application/json"], ["text/html", "application/xhtml+xml"]
FEED = ["application/rss+xml", "application/atom+xml", "application/xml", "text/xml", "application/rdf+xml"]
LENIENT = ["application/octet-stream", "text/plain", ""]


def text_body() -> Column:
    return F.decode(F.col("body"), "UTF-8")


def guard(accepted: list[str], sniff: Column, missing: str) -> Column:
    """The payload's problem before parsing: http_error, empty_body, wrong_content_type or missing; lenient types need the sniff to hold."""
    actual = F.coalesce(content_type(F.col("content_type")), F.lit(""))
    known = F.exists(F.array(*[F.lit(a) for a in accepted]), lambda e: content_type_matches(actual, e))
    return (
        F.when(~F.coalesce(F.col("status").between(200, 299), F.lit(False)), "http_error").when(F.coalesce(F.octet_length("body"), F.lit(0)) == 0, "empty_body")
        .when(~known & ~(actual.isin(*LENIENT) & sniff), "wrong_content_type").when(~sniff, missing)
    )


def day_of() -> Column:
    """The local day on which an occurrence starts."""
    return F.coalesce("start_date", F.to_date(F.from_utc_timestamp("start_instant", F.coalesce("tz", "source_tz", F.lit("UTC")))), F.to_date("start_local"))


def finished(rows: DataFrame, today: dt.date, horizon_days: int) -> DataFrame:
    """rows in the PARSED layout: absent columns null, the horizon (both ends included) judged on the local start day."""
    have = {c.lower() for c in rows.columns}
    full = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in PARSED.fields if f.name.lower() not in have})
    has = F.coalesce(F.col("has_event"), F.lit(True)) & F.col("problem").isNull()
    dated = day_of().isNotNull()
    inside = F.coalesce(day_of().between(F.lit(today), F.lit(today + dt.timedelta(days=horizon_days))), F.lit(False))
    full = full.withColumns({"has_event": has & dated, "undated": has & ~dated, "in_horizon": has & inside})
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARSED.fields])


def events_of(parsed: DataFrame) -> DataFrame:
    """Occurrences in the horizon, in RAW_EVENT columns."""
    return parsed.where("in_horizon").select(*RAW_EVENT.names)


def reports_of(parsed: DataFrame) -> DataFrame:
    """One row per source: its problem if any, counts, the newest change."""
    return parsed.groupBy("space_id", "source_label").agg(
        F.min("problem").alias("problem"), F.min("detail").alias("detail"), F.count_if("has_event").alias("raw_count"), F.count_if("in_horizon").alias("horizon_count"), F.count_if("undated").alias("undated_count"), F.max("newest_change").alias("newest_change")
    )


#: Adapter name to reader; filled by the modules below. None: known but not available, skipped with a reason.
ADAPTERS: dict[str, Callable[..., DataFrame] | None] = {"llm_html": None}


def read_source(adapter: str, payloads: DataFrame, today: dt.date, horizon_days: int = 120, **options) -> DataFrame:
    """PARSED rows of one adapter's payloads; an unknown or unavailable adapter gives a row per payload that says so."""
    import marlstone.sources.feeds
    import marlstone.sources.ics
    import marlstone.sources.jsondocs
    import marlstone.sources.markup  # noqa: F401

    reader = ADAPTERS.get(adapter)
    if reader is None:
        why = "not_implemented" if adapter in ADAPTERS else "unknown_adapter"
        return finished(payloads.select("space_id", "source_label", F.lit(why).alias("problem")), today, horizon_days)
    return reader(payloads, today, horizon_days, **options)
