"""iCalendar payloads: unfolding, components, and recurrence expanded within the horizon."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

import pyarrow as pa
from dateutil import rrule
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marlstone.schemas import ddl
from marlstone.sources.base import ADAPTERS, CALENDAR, PARSED, finished, guard
from marlstone.staging import written

#: Events that a chunk of a calendar holds, more or less.
CHUNK = 200

NAME = re.compile(r'^([A-Za-z0-9-]+)((?:;[A-Za-z0-9-]+=(?:"[^"]*"|[^;:"]*)(?:,(?:"[^"]*"|[^;:"]*))*)*):(.*)$', re.S)
PARAM = re.compile(r';([A-Za-z0-9-]+)=((?:"[^"]*"|[^;:"])*)')
SPAN = re.compile(r"^([+-])?P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$")


def components(text: str) -> list[tuple[str, list[tuple[str, dict, str]]]]:
    """(component, properties) of a calendar, VCALENDAR's own first; properties are (name, parameters, value)."""
    found: list[tuple[str, list]] = [("VCALENDAR", [])]
    stack = [found[0]]
    for line in re.sub(r"\r?\n[ \t]", "", text).splitlines():
        m = NAME.match(line)
        if not m:
            continue
        name, value = m[1].upper(), m[3]
        if name == "BEGIN":
            if value.strip().upper() != "VCALENDAR":
                stack.append((value.strip().upper(), []))
                found.append(stack[-1])
        elif name == "END":
            if len(stack) > 1:
                stack.pop()
        else:
            stack[-1][1].append((name, {k.upper(): v.strip('"') for k, v in PARAM.findall(m[2])}, value))
    return found


def unescape(value: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] in "nN" else m[1], value, flags=re.S)


def moment(value: str, params: dict) -> tuple[dt.date | dt.datetime | None, str, str | None]:
    """(value, form, zone): form is date, utc, tzid or floating; an unknown zone leaves the time floating."""
    value, zone = value.strip(), params.get("TZID")
    try:
        if re.fullmatch(r"\d{8}", value):
            return dt.datetime.strptime(value, "%Y%m%d").date(), "date", None
        at = dt.datetime.strptime(value.rstrip("Zz"), "%Y%m%dT%H%M%S")
    except ValueError:
        return None, "unknown", None
    if value[-1] in "Zz":
        return at.replace(tzinfo=dt.timezone.utc), "utc", "UTC"
    if zone:
        try:
            return at.replace(tzinfo=ZoneInfo(zone)), "tzid", zone
        except (ZoneInfoNotFoundError, ValueError):
            return at, "floating", None
    return at, "floating", None


def occurrences(start: dt.date | dt.datetime, rules: list[str], extra: list, gone: set, first: dt.date, last: dt.date, reach: dt.timedelta = dt.timedelta(0)) -> Iterator[dt.date | dt.datetime]:
    """Starts of a series between two days, both included, counted in its own wall clock; never unbounded."""
    whole_day = not isinstance(start, dt.datetime)
    zone = None if whole_day else start.tzinfo
    wall = lambda x: dt.datetime.combine(x, dt.time()) if not isinstance(x, dt.datetime) else (x.astimezone(zone) if zone and x.tzinfo else x).replace(tzinfo=None)
    low, high = dt.datetime.combine(first, dt.time()) - reach, dt.datetime.combine(last, dt.time(23, 59, 59))
    base, seen = wall(start), set()
    starts = {base, *(wall(x) for x in extra)}
    for rule in rules:
        parts = dict(p.split("=", 1) for p in rule.strip().split(";") if "=" in p)
        if "UNTIL" in parts:
            until, _, _ = moment(parts["UNTIL"], {})
            if until is not None:
                end = wall(until) if isinstance(until, dt.datetime) else dt.datetime.combine(until, dt.time(23, 59, 59) if not whole_day else dt.time())
                parts["UNTIL"] = end.strftime("%Y%m%dT%H%M%S")
        try:
            found = rrule.rrulestr(";".join(f"{k}={v}" for k, v in parts.items()), dtstart=base)
        except (ValueError, TypeError):
            continue
        starts |= set(found.between(low, high, inc=True))
    without = {wall(x) for x in gone}
    for at in sorted(starts):
        if low <= at <= high and at not in without and at not in seen:
            seen.add(at)
            yield at.date() if whole_day else at.replace(tzinfo=zone)


@lru_cache(maxsize=2048)
def _expanded(start: dt.datetime, rule: str, first: dt.date, last: dt.date) -> tuple[tuple[dt.datetime], ...]:
    return tuple((at,) for at in occurrences(start, [rule], [], set(), first, last))


@udtf(returnType="occurrence timestamp_ntz")
class ExpandRule:
    """expand_rrule(dtstart, rule, first, last): the wall-clock starts of a rule between two days; series of one start and rule are expanded once."""

    def eval(self, start: dt.datetime, rule: str, first: dt.date, last: dt.date):
        if start is not None and rule:
            yield from _expanded(start, rule, first, last)


def _span(text: str) -> dt.timedelta:
    m = SPAN.match(text.strip())
    if not m:
        return dt.timedelta(0)
    w, d, h, mi, s = (int(x or 0) for x in m.groups()[1:])
    return (-1 if m[1] == "-" else 1) * dt.timedelta(weeks=w, days=d, hours=h, minutes=mi, seconds=s)


def parse(text: str, first: dt.date, last: dt.date) -> tuple[list[dict], dict[str, dt.datetime | None], str | None]:
    """(occurrences as rows, newest LAST-MODIFIED and DTSTAMP, calendar zone) of one calendar."""
    calendar, *parts = components(text)
    own = lambda props, name: [(p, v) for n, p, v in props if n == name]
    zone = next((v.strip() for _, v in own(calendar[1], "X-WR-TIMEZONE")), None)
    events = [props for kind, props in parts if kind == "VEVENT"]
    changes = {name: [m for props in [*events, *([calendar[1]] if name == "LAST-MODIFIED" else [])] for p, v in own(props, name) if isinstance(m := moment(v, p)[0], dt.datetime)] for name in ("LAST-MODIFIED", "DTSTAMP")}
    newest = {name: max((x if x.tzinfo else x.replace(tzinfo=dt.timezone.utc) for x in found), default=None) for name, found in changes.items()}
    text_of = lambda props, name: next((unescape(v).strip() or None for _, v in own(props, name)), None)
    masters: dict[str | None, list] = {}
    for props in events:
        masters.setdefault(text_of(props, "UID"), props)
    replaced: dict[str | None, set] = {}
    for props in events:
        for p, v in own(props, "RECURRENCE-ID"):
            replaced.setdefault(text_of(props, "UID"), set()).add(moment(v, p)[0])
    rows = []
    for props in events:
        head = own(props, "DTSTART")
        start, form, source_tz = moment(head[0][1], head[0][0]) if head else (None, "unknown", None)
        if start is None:
            rows.append({"undated": True, "source_uid": text_of(props, "UID"), "title": text_of(props, "SUMMARY")})
            continue
        tail = own(props, "DTEND")
        end = moment(tail[0][1], tail[0][0])[0] if tail else None
        whole_day = not isinstance(start, dt.datetime)
        if end is None and own(props, "DURATION"):
            end = start + _span(own(props, "DURATION")[0][1])
        if end is not None and (isinstance(end, dt.datetime) == whole_day or (not whole_day and (end.tzinfo is None) != (start.tzinfo is None))):
            end = None
        length = end - start if end is not None else None
        override = bool(own(props, "RECURRENCE-ID"))
        uid = text_of(props, "UID")
        source = masters.get(uid, props) if uid is not None else props
        rules = [] if override else [v for _, v in own(props, "RRULE")]
        several = lambda name, props=props: [m for p, v in own(props, name) for x in v.split(",") if (m := moment(x.split("/")[0], p)[0]) is not None]
        gone = set(several("EXDATE")) | (set() if override else {x for x in replaced.get(uid, ()) if x is not None})
        gone = {x for x in gone if isinstance(x, dt.datetime) != whole_day}
        if override:
            gone = set()
        reach = dt.timedelta(days=max(0, (length.days if whole_day and length else 0) - 1)) if whole_day else (length or dt.timedelta(0))
        recurring = bool(own(source, "RRULE") or own(source, "RDATE"))
        categories = list(dict.fromkeys(c for _, v in own(props, "CATEGORIES") for x in re.split(r"(?<!\\),", v) if (c := unescape(x).strip())))
        for at in occurrences(start, rules, [] if override else several("RDATE"), gone, first, last, max(reach, dt.timedelta(0))):
            until = at + length if length is not None else None
            row = {"source_uid": uid, "title": text_of(props, "SUMMARY"), "all_day": whole_day, "dtstart_form": form, "source_tz": source_tz, "recurring": recurring, "location": text_of(props, "LOCATION"), "description": text_of(props, "DESCRIPTION"), "url": text_of(props, "URL"), "status": text_of(props, "STATUS"), "categories": categories}
            if whole_day:
                closing = max(until - dt.timedelta(days=1), at) if until is not None else at
                row |= {"start_date": at, "end_date": closing, "days": (closing - at).days + 1}
            else:
                row["days"] = max((until.date() - at.date()).days + 1, 1) if until is not None else 1
                row |= {"start_instant": at, "end_instant": until, "tz": source_tz} if at.tzinfo else {"start_local": at, "end_local": until, "tz": zone}
            rows.append(row)
    return rows, newest, zone


def chunks(calendars: DataFrame) -> DataFrame:
    """calendars (pid, .., text) cut into calendars of about CHUNK events each, so that no task of Python holds a whole one.

    Events of one UID stay together, in their order, for a series, its overrides
    and repeated UIDs are read as one; every chunk has the calendar's zone.
    """
    plain = F.regexp_replace("text", "\r?\n[ \t]", "")
    outside = lambda c: F.regexp_replace(c, r"(?is)(?<=[\r\n])BEGIN:(?!VCALENDAR)([A-Z0-9-]+).*?[\r\n]END:\1[^\r\n]*", "")
    zone = lambda c: F.regexp_extract(c, r"(?i)[\r\n](X-WR-TIMEZONE[;:][^\r\n]*)", 1)
    parts = calendars.withColumn("text", plain).withColumn("parts", F.split("text", r"(?i)(?<=\n)(?=BEGIN:VEVENT[ \t]*[\r\n])"))
    head = zone(outside(F.get("parts", F.lit(0))))  # as a rule the zone stands before the events
    parts = parts.withColumn("own", F.when(head != "", head).when(zone(F.col("text")) != "", zone(outside(F.col("text")))).otherwise("")).drop("text")
    pieces = parts.withColumn("many", F.ceil(F.size("parts") / CHUNK)).select("*", F.posexplode_outer("parts").alias("pos", "piece")).drop("parts")
    inner = F.when(F.col("piece").rlike(r"(?i)[\r\n]BEGIN:(?!VEVENT)"), F.regexp_replace("piece", r"(?is)(?<=[\r\n])BEGIN:(?!VEVENT|VCALENDAR)([A-Z0-9-]+).*?[\r\n]END:\1", "")).otherwise(F.col("piece"))
    uid = F.trim(F.regexp_replace(F.regexp_extract(inner, r"(?i)[\r\n]UID(?:;[^:\r\n]*)?:([^\r\n]*)", 1), r"\\", ""))
    chunk = F.pmod(F.when(uid == "", F.xxhash64("pos")).otherwise(F.xxhash64(uid)), F.greatest("many", F.lit(1)))
    keys = [c for c in pieces.columns if c not in ("own", "many", "pos", "piece")]
    found = pieces.withColumn("chunk", chunk).groupBy(*keys, "chunk").agg(F.first("own").alias("own"), F.sort_array(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece")))).alias("p"))
    return found.select(*keys, F.concat("own", F.lit("\r\n"), F.array_join(F.transform("p", lambda x: x["piece"]), "")).alias("text"))


def read_ics(payloads: DataFrame, today: dt.date, horizon_days: int = 120) -> DataFrame:
    """PARSED rows of calendars. Series are expanded between today and the horizon only."""
    last = today + dt.timedelta(days=horizon_days)
    text = F.col("body").cast("string")  # no copy, unlike decode
    looks = F.contains(F.substring(text, 1, 4096), F.lit("BEGIN:VCALENDAR"))
    checked = payloads.select(F.monotonically_increasing_id().alias("pid"), "space_id", "source_label", guard(CALENDAR, F.coalesce(looks, F.lit(False)), "not_calendar").alias("problem"), text.alias("text"))
    checked = chunks(checked.withColumn("text", F.when(F.col("problem").isNull(), F.col("text"))))
    chunked = StructType([*PARSED.fields, *ddl("pid long, modified timestamp, stamped timestamp").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(chunked)
        for b in batches:
            for i in range(b.num_rows):
                pid, space, label, problem, text = (c[i].as_py() for c in b.columns)
                rows, newest, _ = ([], {}, None) if problem else parse(text, today, last)
                base = {"pid": pid, "space_id": space, "source_label": label, "problem": problem, "modified": newest.get("LAST-MODIFIED"), "stamped": newest.get("DTSTAMP")}
                out = [base | r | {"has_event": True} for r in rows] or [base | {"has_event": False}]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in schema], schema=schema)

    rows = written(checked.mapInArrow(run, chunked))
    newest = rows.groupBy("pid").agg(F.coalesce(F.max("modified"), F.max("stamped")).alias("newest_change"))
    return finished(rows.drop("newest_change").join(newest.select("pid", "newest_change"), "pid"), today, horizon_days)


ADAPTERS["ics"] = ADAPTERS["gcal_ics"] = read_ics
