"""RSS, Atom and RDF payloads: as events, as a sign of life, or as a list of pages to follow."""

from __future__ import annotations

import datetime as dt
import hashlib
import html
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from marlstone.functions.text import clean, ordered_distinct, strip_tags
from marlstone.functions.times import feed_date
from marlstone.sources.base import ADAPTERS, FEED, finished, guard

ITEMS = ArrayType(StructType([*[StructField(c, StringType()) for c in ("guid", "title", "link", "date", "description")], StructField("categories", ArrayType(StringType()))]))
ITEM_BLOCK = re.compile(r"<(item|entry)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
ROOT = r"(?is)^\s*(?:<\?xml[^>]*\?>\s*)?(?:<!--.*?-->\s*|<!doctype[^>]*>\s*|<\?[^>]*\?>\s*)*<(?:rss|feed|rdf:rdf|[a-z0-9]+:feed)\b"


def _local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1].lower() if isinstance(tag, str) else ""


def _item(children: list[tuple[str, str | None, dict]]) -> dict:
    text = lambda *names: next((t.strip() for n in names for tag, t, _ in children if tag == n and t and t.strip()), None)
    hrefs = [a["href"] for tag, _, a in children if tag == "link" and a.get("href") and a.get("rel", "alternate") == "alternate"]
    link = text("link") or next(iter(hrefs), None)
    return {"guid": text("guid", "id") or link, "title": text("title"), "link": link, "date": text("pubdate", "published", "updated", "date"), "description": text("encoded", "description", "content", "summary"), "categories": [c for tag, t, a in children if tag == "category" and (c := (a.get("term") or t or "").strip())]}


def parse(text: str) -> list[dict] | None:
    """Items of a feed whatever its namespaces; broken XML is read item by item. None: nothing readable."""
    try:
        root = ElementTree.fromstring(text.encode())
        return [_item([(_local(c.tag), "".join(c.itertext()), {_local(k): v for k, v in c.attrib.items()}) for c in node]) for node in root.iter() if _local(node.tag) in ("item", "entry")]
    except ElementTree.ParseError:
        found = []
        for m in ITEM_BLOCK.finditer(text):
            fields = re.findall(r"<(?:[\w-]+:)?([\w-]+)\b([^>]*?)(?:/>|>(.*?)</(?:[\w-]+:)?\1\s*>)", m[2], re.S)
            plain = lambda t: html.unescape(re.sub(r"^\s*<!\[CDATA\[(.*?)\]\]>\s*$", r"\1", t, flags=re.S))
            found.append(_item([(n.lower(), plain(t), dict(re.findall(r'([\w-]+)\s*=\s*"([^"]*)"', a))) for n, a, t in fields]))
        return found or None


class _Silent:
    """Builds nothing: a parse that only says whether the XML is sound."""

    def start(self, tag, attributes): ...

    def end(self, tag): ...

    def data(self, text): ...

    def close(self): ...


def _fed(parser, body: memoryview) -> Iterator[None]:
    for lo in range(0, len(body), 1 << 16):
        parser.feed(bytes(body[lo : lo + (1 << 16)]))
        yield
    parser.close()
    yield


def streamed(body: memoryview) -> Iterator[dict] | None:
    """parse, one item at a time: the body is read twice, first for soundness, and no more than an item of it is held as elements."""
    try:
        for _ in _fed(ElementTree.XMLParser(target=_Silent()), body):
            pass
    except ElementTree.ParseError:
        found = parse(bytes(body).decode(errors="replace"))
        return None if found is None else iter(found)

    def sound() -> Iterator[dict]:
        pull, stack, held, within = ElementTree.XMLPullParser(("start", "end")), [], [], 0
        for _ in _fed(pull, body):
            for event, node in pull.read_events():
                entry = _local(node.tag) in ("item", "entry")
                if event == "start":
                    stack.append(node)
                    within += entry
                    if entry:
                        held.append(node)  # in the order in which they begin
                    continue
                stack.pop()
                within -= entry
                if not within:
                    yield from (_item([(_local(c.tag), "".join(c.itertext()), {_local(k): v for k, v in c.attrib.items()}) for c in h]) for h in held)
                    held = []
                    if stack:
                        stack[-1].remove(node)

    return sound()


#: Bytes of a body in which its root element must begin.
PROLOG = 1 << 20
ITEM_ROWS = StructType([*[StructField(c, StringType()) for c in ("space_id", "source_label", "feed_url", "problem")], StructField("pid", LongType()), StructField("pos", LongType()), StructField("i", ITEMS.elementType), StructField("digest", StringType())])


def items(payloads: DataFrame) -> DataFrame:
    """(space_id, source_label, feed_url, problem, pid, pos, i, digest): a row an item, or one without for a payload that has none; a body that is not a feed fails whatever its header says.

    The digest, over the items' guids in order, stands in a payload's last row.
    """
    sniff = F.coalesce(F.substring("body", 1, PROLOG).cast("string").rlike(ROOT), F.lit(False))
    problem = guard([*FEED, "text/html", "text/plain"], sniff, "not_feed")
    bodies = payloads.select("space_id", "source_label", F.col("url").alias("feed_url"), problem.alias("problem"), F.monotonically_increasing_id().alias("pid"), F.when(problem.isNull(), F.col("body")).alias("text"))  # bytes as they are: a large body is copied as seldom as can be

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(ITEM_ROWS)
        batch = lambda rows: pa.RecordBatch.from_pylist(rows, schema=schema)
        for b in batches:
            for n in range(b.num_rows):
                *own, text = (c[n] for c in b.columns)
                base = dict(zip(("space_id", "source_label", "feed_url", "problem", "pid"), (x.as_py() for x in own), strict=True))
                found = streamed(memoryview(text.as_buffer())) if text.is_valid and len(text.as_buffer()) else None
                if found is None:
                    yield batch([base | {"problem": base["problem"] or "unparseable"}])
                    continue
                rows, digest, pos = [], hashlib.sha1(), -1
                for pos, item in enumerate(found):
                    if len(rows) == 2000:
                        yield batch(rows)
                        rows = []
                    digest.update(("\n" if pos else "").encode() + (item["guid"] or "").encode())
                    rows.append(base | {"pos": pos, "i": item})
                rows = rows or [base | {"pos": None, "i": None}]
                rows[-1]["digest"] = digest.hexdigest()[:16]
                yield batch(rows)

    return bodies.mapInArrow(run, ITEM_ROWS)


def read_rss(payloads: DataFrame, today: dt.date, horizon_days: int = 120, mode: str = "change_detection", zone: str = "America/Los_Angeles") -> DataFrame:
    """PARSED rows. mode events: each item's date is its start; change_detection and seed_list give no events, only the newest change."""
    rows = items(payloads)
    at = feed_date(F.col("i.date"))
    floating = F.col("i.date").rlike(r"-0000\s*$")
    if mode != "events":
        return finished(rows.groupBy("space_id", "source_label").agg(F.min("problem").alias("problem"), F.max(at).alias("newest_change")).withColumn("has_event", F.lit(False)), today, horizon_days)
    return finished(rows.select(
        "space_id", "source_label", "problem", F.col("i").isNotNull().alias("has_event"), F.col("i.guid").alias("source_uid"), clean(F.col("i.title")).alias("title"), F.lit(False).alias("all_day"), F.when(~floating, at).alias("start_instant"), F.when(floating, at.cast("timestamp_ntz")).alias("start_local"),
        F.lit(zone).alias("tz"), F.when(floating, "floating").otherwise("offset").alias("dtstart_form"), F.col("i.link").alias("url"), strip_tags(F.col("i.description")).alias("description"), ordered_distinct(F.col("i.categories")).alias("categories"), at.alias("newest_change"),
    ), today, horizon_days)


def liveness_digest(identities: Column) -> Column:
    """First 16 hex digits of the digest over identities in order."""
    return F.substring(F.sha1(F.array_join(identities, "\n")), 1, 16)


def liveness(payloads: DataFrame) -> DataFrame:
    """(space_id, source_label, problem, item_count, oldest, newest, digest): a change-detection feed's sign of life."""
    at = feed_date(F.col("i.date"))
    rows = items(payloads).groupBy("pid", "space_id", "source_label", "problem").agg(F.count("i").cast("int").alias("item_count"), F.min(at).alias("oldest"), F.max(at).alias("newest"), F.max("digest").alias("digest"))
    return rows.drop("pid")


def links(payloads: DataFrame) -> DataFrame:
    """(space_id, source_label, feed_url, link, pos): the pages a seed feed names."""
    return items(payloads).where("i.link is not null").select("space_id", "source_label", "feed_url", F.col("i.link").alias("link"), "pos")


ADAPTERS["rss"] = read_rss
