"""StructTypes of the event engine."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_PLAIN = {"string": T.StringType, "long": T.LongType, "bigint": T.LongType, "int": T.IntegerType, "boolean": T.BooleanType, "double": T.DoubleType, "date": T.DateType, "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType, "binary": T.BinaryType}


def ddl(text: str) -> T.StructType:
    """A schema from its DDL text, without a running session."""
    tokens = re.findall(r"\w+|[<>,:]", text)

    def kind() -> T.DataType:
        name = tokens.pop(0)
        if name in _PLAIN:
            return _PLAIN[name]()
        tokens.pop(0)
        if name == "struct":
            out: T.DataType = fields(">")
        elif name == "array":
            out = T.ArrayType(kind())
        else:
            key = kind()
            tokens.pop(0)
            out = T.MapType(key, kind())
        tokens.pop(0)
        return out

    def fields(until: str | None) -> T.StructType:
        found = []
        while tokens and tokens[0] != until:
            name = tokens.pop(0)
            if tokens[0] == ":":
                tokens.pop(0)
            found.append(T.StructField(name, kind()))
            if tokens and tokens[0] == ",":
                tokens.pop(0)
        return T.StructType(found)

    return fields(None)



#: One occurrence in a source's own terms. start_date for all-day events, start_instant for aware times, start_local for floating ones.
RAW_EVENT = ddl(
    "space_id string, source_label string, source_uid string, title string, start_date date, end_date date, start_instant timestamp, end_instant timestamp, "
    "start_local timestamp_ntz, end_local timestamp_ntz, all_day boolean, days int, tz string, source_tz string, dtstart_form string, recurring boolean, "
    "location string, description string, url string, categories array<string>, price string, status string, extras map<string,string>"
)
#: One row per source and run: how parsing went. problem is null when all is well.
PARSE_REPORT = ddl("space_id string, source_label string, problem string, detail string, raw_count long, horizon_count long, undated_count long, newest_change timestamp")
#: What a fetch left in the landing zone.
PAYLOAD = ddl("space_id string, source_label string, url string, status int, content_type string, headers map<string,string>, body binary, outcome string, fetched_at timestamp")
SPACES = ddl("space_id string, name string, url string, timezone string, address_override string, ordinal int, health struct<allow_zero:boolean,ignore_count_drop:boolean,require_nonzero_once:boolean,max_stale_days:int>")
SOURCES = ddl(
    "space_id string, source_label string, adapter string, url string, calendar_id string, enabled boolean, todo boolean, trust int, params map<string,string>, script_id string, shape string, rss_mode string, pubdate_means string, "
    "filters struct<title_contains:array<string>,title_excludes:array<string>,location_contains:array<string>,location_excludes:array<string>,categories_exclude:array<string>,location_allow_when_missing:boolean>, "
    "health struct<allow_zero:boolean,ignore_count_drop:boolean,require_nonzero_once:boolean,max_stale_days:int>, ordinal int"
)
EVENT_COLUMNS = [
    "uid", "space_id", "source_label", "title", "start_utc", "end_utc", "tz", "all_day", "location_name", "address", "url", "price", "description", "categories", "summary_line", "rrule", "first_seen", "last_seen",
    "content_hash", "source_uid", "dtstart_form", "tz_assumed", "recurring", "multi_day", "days", "start_date", "end_date", "address_source", "off_site", "quarantine",
]
