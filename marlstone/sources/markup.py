"""HTML payloads: JSON-LD blocks and agenda rows."""

from __future__ import annotations

import datetime as dt
import html
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from marlstone.functions.fuzzy import html_unescape
from marlstone.functions.text import clean, strip_tags
from marlstone.sources.base import ADAPTERS, HTML, finished, guard, text_body

#: Keys under which JSON-LD nests further items.
CONTAINERS = ("@graph", "itemListElement", "item", "mainEntity", "mainEntityOfPage", "subEvent", "event", "events")
LD_BLOCK = r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
LD_EVENT = ArrayType(StructType([StructField(c, StringType()) for c in ("uid", "title", "start", "end", "location", "price", "url", "status", "description", "kind")]))


def is_event(node: object) -> bool:
    kinds = node.get("@type") if isinstance(node, dict) else None
    names = [kinds] if isinstance(kinds, str) else kinds if isinstance(kinds, list) else []
    return any(isinstance(k, str) and k.rsplit("/", 1)[-1].endswith(("Event", "Hackathon", "Festival")) or k == "CourseInstance" for k in names)


def _text(x: object) -> str | None:
    if isinstance(x, list):
        x = next((y for y in x if _text(y)), None)
    if isinstance(x, dict):
        x = x.get("name") or x.get("@value") or x.get("url") or x.get("@id")
    return html.unescape(str(x)).strip() or None if isinstance(x, (str, int, float)) and not isinstance(x, bool) else None


def _place(x: object) -> str | None:
    if isinstance(x, list):
        x = next((y for y in x if _place(y)), None)
    if not isinstance(x, dict):
        return _text(x)
    at = x.get("address")
    parts = [_text(x.get("name")), *([_text(at.get(k)) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode")] if isinstance(at, dict) else [_text(at)])]
    return ", ".join(dict.fromkeys(p for p in parts if p)) or _text(x.get("url"))


def _price(x: object) -> str | None:
    if isinstance(x, list):
        x = next((y for y in x if _price(y)), None)
    if not isinstance(x, dict):
        return None
    low, high = (x.get(k) for k in ("lowPrice", "highPrice"))
    shown = lambda v: "Free" if str(v) in ("0", "0.0", "0.00") else f"{'$' if x.get('priceCurrency', 'USD') == 'USD' else x['priceCurrency'] + ' '}{v}"
    if low is not None and high is not None and low != high:
        return f"{shown(low)} - {shown(high)}"
    value = x.get("price", low)
    return None if value is None or value == "" else shown(value)


def walk(document: str) -> tuple[list[dict], bool]:
    """(events, whole) of one block: the walk goes through container keys and stops at an event; whole is false if the JSON is broken."""
    try:
        stack, found = [json.loads(document, strict=False)], []
    except ValueError:
        return [], False
    while stack:
        node = stack.pop(0)
        if isinstance(node, list):
            stack[:0] = node
        elif is_event(node):
            kind = node.get("@type")
            status = (_text(node.get("eventStatus")) or "").rsplit("/", 1)[-1].removeprefix("Event").upper() or None
            found.append({"uid": _text(node.get("@id") or node.get("identifier")), "title": _text(node.get("name")), "start": _text(node.get("startDate")), "end": _text(node.get("endDate")), "location": _place(node.get("location")), "price": _price(node.get("offers")), "url": _text(node.get("url")), "status": status, "description": _text(node.get("description")), "kind": kind if isinstance(kind, str) else ",".join(map(str, kind))})
        elif isinstance(node, dict):
            stack[:0] = [node[k] for k in CONTAINERS if k in node]
    return found, True


@pandas_udf(StructType([StructField("events", LD_EVENT), StructField("whole", BooleanType())]))
def ld_parsed(blocks: pd.Series) -> pd.DataFrame:
    """Events of all blocks of a page, and whether every block is sound JSON; each is parsed once."""
    walked = [[walk(b) for b in each] if each is not None else [] for each in blocks]
    return pd.DataFrame({"events": [[e for found, _ in page for e in found] for page in walked], "whole": [all(ok for _, ok in page) for page in walked]})


@udtf(returnType="uid string, title string, start string, end string, location string, price string, url string, status string, description string, kind string")
class JsonLdEvents:
    """jsonld_events(block): the events of one JSON-LD block."""

    def eval(self, block: str):
        for e in walk(block or "")[0]:
            yield tuple(e.values())


def read_jsonld(payloads: DataFrame, today: dt.date, horizon_days: int = 120, zone: str = "America/Los_Angeles") -> DataFrame:
    """Events in JSON-LD blocks of pages; a page whose blocks hold none, or whose JSON is broken, says so."""
    blocks = F.regexp_extract_all(text_body(), F.lit(LD_BLOCK), F.lit(1))
    pages = payloads.select("space_id", "source_label", "url", guard(HTML, F.coalesce(F.contains(F.lower(text_body()), F.lit("<")), F.lit(False)), "not_html").alias("problem"), blocks.alias("blocks"))
    pages = pages.withColumn("p", ld_parsed(F.when(F.col("problem").isNull(), F.col("blocks")))).withColumn("e", F.col("p.events"))
    said = F.when(F.size("blocks") == 0, "no_jsonld").when((F.size("e") == 0) & ~F.col("p.whole"), "unparseable").when(F.size("e") == 0, "no_events")
    pages = pages.withColumn("problem", F.coalesce("problem", said))
    rows = pages.select("space_id", "source_label", "url", "problem", F.explode_outer("e").alias("e"))
    whole = ~F.contains(F.col("e.start"), F.lit("T")) & (F.length("e.start") <= 10)
    zoned = lambda c: c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    at = lambda c: F.try_to_timestamp(c)
    s, e = F.col("e.start"), F.col("e.end")
    return finished(rows.select(
        "space_id", "source_label", "problem", F.col("e").isNotNull().alias("has_event"), F.coalesce("e.uid", "e.url").alias("source_uid"), F.col("e.title").alias("title"), F.coalesce(whole, F.lit(False)).alias("all_day"), F.when(whole, F.expr("try_cast(e.start AS DATE)")).alias("start_date"), F.when(whole, F.expr("try_cast(substr(e.end, 1, 10) AS DATE)")).alias("end_date"),
        F.when(~whole & zoned(s), at(s)).alias("start_instant"), F.when(~whole & zoned(e), at(e)).alias("end_instant"), F.when(~whole & ~zoned(s), at(s).cast("timestamp_ntz")).alias("start_local"), F.when(~whole & ~zoned(e), at(e).cast("timestamp_ntz")).alias("end_local"), F.lit(zone).alias("tz"),
        F.when(whole, "date").when(zoned(s), "offset").otherwise("floating").alias("dtstart_form"), F.col("e.location").alias("location"), F.col("e.price").alias("price"), F.coalesce("e.url", F.col("url")).alias("url"), F.col("e.status").alias("status"), strip_tags(F.col("e.description")).alias("description"),
    ), today, horizon_days)


AGENDA_ROW = r"""(?is)<tr\b[^>]*data-event\s*=\s*["']ev-[^"']*["'].*?</tr>"""


#: A string literal with a table row. Its loops are possessive: Java's others take a stack frame a character, and a long page overflows the stack.
ROW_LITERAL = r'"((?:[^"\\<]++|\\.|<(?!tr))*+<tr(?:[^"\\]++|\\.)*+)"'


def agenda_fragments(body: Column) -> Column:
    """HTML of a page, or of the string literals of a script that inserts it."""
    literals = F.regexp_extract_all(body, F.lit(ROW_LITERAL), F.lit(1))
    decoded = F.array_join(F.transform(literals, lambda x: F.get_json_object(F.concat(F.lit('{"x":"'), x, F.lit('"}')), "$.x")), "")
    return F.when(~F.ltrim(body).startswith("<") & (F.size(literals) > 0), decoded).otherwise(body)


def read_agenda(payloads: DataFrame, today: dt.date, horizon_days: int = 120, zone: str = "America/Los_Angeles") -> DataFrame:
    """Agenda tables: rows whose data-event is ev-{id}-{yyyyMMddHHmmss}; an agenda that says it is empty is a legitimate zero."""
    page = agenda_fragments(text_body())
    rows = F.regexp_extract_all(page, F.lit(AGENDA_ROW), F.lit(0))
    says_empty = page.rlike(r"""(?is)data-hook\s*=\s*["'](agenda-empty|no-events|empty-state)["']""")
    known = F.contains(F.lower(page), F.lit("agenda")) | F.contains(page, F.lit("data-event"))
    problem = F.coalesce(guard([*HTML, "text/javascript", "application/javascript"], F.coalesce(F.contains(text_body(), F.lit("<")), F.lit(False)), "not_html"), F.when(~known, "not_agenda").when((F.size(rows) == 0) & ~says_empty, "no_rows"))
    found = payloads.select("space_id", "source_label", "url", problem.alias("problem"), F.array_distinct(rows).alias("rows"))
    found = found.select("space_id", "source_label", "url", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("rows"))).alias("r"))
    mark = F.regexp_extract("r", r"""(?is)data-event\s*=\s*["']ev-([^"']*)-(\d{14})["']""", 2)
    cell = lambda name: clean(html_unescape(strip_tags(F.regexp_extract("r", rf"""(?is)<(\w+)\b[^>]*class\s*=\s*["'][^"']*\b{name}\b[^"']*["'][^>]*>(.*?)</\1>""", 2))))
    link = F.regexp_extract("r", r"""(?is)<a\b[^>]*href\s*=\s*["']([^"']+)["']""", 1)
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    return finished(found.select(
        "space_id", "source_label", "problem", F.col("r").isNotNull().alias("has_event"), F.regexp_extract("r", r"""(?is)data-event\s*=\s*["'](ev-[^"']*)["']""", 1).alias("source_uid"), F.coalesce(cell("title"), clean(html_unescape(strip_tags(F.regexp_extract("r", r"(?is)<a\b[^>]*>(.*?)</a>", 1))))).alias("title"), F.lit(False).alias("all_day"),
        F.try_to_timestamp(F.nullif(mark, F.lit("")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz").alias("start_local"), F.lit(zone).alias("tz"), F.lit("floating").alias("dtstart_form"), cell("location").alias("location"), cell("price").alias("price"),
        F.when(link.startswith("/"), F.concat(origin, link)).otherwise(F.nullif(link, F.lit(""))).alias("url"),
    ), today, horizon_days)


def seed_verdicts(pages: DataFrame) -> DataFrame:
    """(space_id, source_label, problem, pages, failed) of followed seed pages (.., problem): a source fails if all of its pages do; some that fail are a note."""
    counts = pages.groupBy("space_id", "source_label").agg(F.count("*").alias("pages"), F.count("problem").alias("failed"), F.min("problem").alias("first"))
    return counts.select("space_id", "source_label", F.when(F.col("failed") == F.col("pages"), F.col("first")).when(F.col("failed") > 0, "some_pages_failed").alias("problem"), "pages", "failed")


def seed_links(links: DataFrame, most: int = 20) -> DataFrame:
    """(space_id, source_label, link, problem) of a seed list (.., feed_url, link, pos): distinct, the feed's host only, no format= routes, at most so many."""
    from pyspark.sql import Window

    host = lambda c: F.lower(F.try_parse_url(c, F.lit("HOST")))
    first = links.groupBy("space_id", "source_label", "feed_url", "link").agg(F.min("pos").alias("pos"))
    kept = first.where((host(F.col("link")) == host(F.col("feed_url"))) & F.try_parse_url("link", F.lit("QUERY"), F.lit("format")).isNull())
    nth = F.row_number().over(Window.partitionBy("space_id", "source_label").orderBy("pos"))
    return kept.withColumn("nth", nth).where(F.col("nth") <= most).select("space_id", "source_label", "link", "nth")


ADAPTERS |= {"jsonld": read_jsonld, "bookwhen_html": read_agenda}
