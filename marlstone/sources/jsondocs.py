"""JSON payloads: REST pages, keyed documents, product lists, and blobs embedded in HTML.

Items are read with explicit schemas (from_json) or as VARIANT with declared
paths; nothing is inferred, and a document of another shape is a verdict.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.fuzzy import html_unescape
from marlstone.functions.text import clean, minor_unit_price, money, ordered_distinct, strip_tags
from marlstone.functions.times import epoch_instant, us_short
from marlstone.sources.base import ADAPTERS, HTML, JSON, finished, guard, text_body

TRIBE = (
    "events array<struct<id:bigint,status:string,url:string,title:string,description:string,all_day:boolean,start_date:string,end_date:string,utc_start_date:string,utc_end_date:string,timezone:string,cost:string,modified_utc:string,"
    "venue:string,categories:array<struct<name:string>>,tags:array<struct<name:string>>>>, total bigint, total_pages bigint, next_rest_url string"
)
VENUE = "venue string, address string, city string, state string, province string, zip string, country string"


def _looks_json() -> Column:
    return F.coalesce(F.ltrim(text_body()).rlike(r"^[\[{]"), F.lit(False))


#: Pages of one source beyond which a catalog counts as endless.
MOST_PAGES = 20


def paged(pages: DataFrame, most: int = MOST_PAGES) -> DataFrame:
    """pages (space_id, source_label, url, problem, next_url) with the source's verdict in problem.

    The page that no other names is the first. A source whose pages name a next
    one that was not landed is truncated (missing_page); one that names a page
    already read, or more than most pages, never ends (runaway_pagination); a
    later page that fails, fails the whole source. Rows of the source's other
    pages then carry the problem too, so that nothing of it is published.
    """
    key = ["space_id", "source_label"]
    named = pages.select(*key, F.col("next_url").alias("url")).where("url is not null").groupBy(*key, "url").agg(F.count("*").alias("_named"))
    seen = pages.join(named, [*key, "url"], "left")
    known = pages.select(*key, F.col("url").alias("next_url"), F.lit(True).alias("_landed")).distinct()
    seen = seen.join(known, [*key, "next_url"], "left")
    own = Window.partitionBy(*key)
    heads, count = F.sum(F.col("_named").isNull().cast("int")).over(own), F.count("*").over(own)
    # every page names one other: without a first page, or with a page named twice, the chain closes on itself
    loop = (heads == 0) | (F.max(F.coalesce("_named", F.lit(0))).over(own) > 1) | F.max((F.col("next_url") == F.col("url")).cast("int")).over(own).cast("boolean")
    endless = F.when(F.coalesce(loop, F.lit(False)) | (count > most), "runaway_pagination")
    missing = F.when(F.max((F.col("next_url").isNotNull() & F.col("_landed").isNull()).cast("int")).over(own) == 1, "missing_page")
    return seen.withColumn("problem", F.coalesce("problem", endless, F.when(count > 1, F.min("problem").over(own)), missing)).drop("_named", "_landed")


def read_tribe(payloads: DataFrame, today: dt.date, horizon_days: int = 120) -> DataFrame:
    """Events-calendar REST pages; each payload is a page, and all pages of a source stand or fall together (paged)."""
    page = payloads.select("space_id", "source_label", "url", guard(JSON, _looks_json(), "not_json").alias("problem"), F.from_json(text_body(), TRIBE, {"mode": "PERMISSIVE"}).alias("d"))
    page = page.withColumn("problem", F.coalesce("problem", F.when(F.col("d.events").isNull(), F.when(F.coalesce(F.col("d.total"), F.lit(-1)) == 0, None).otherwise("unexpected_shape")).when((F.size("d.events") == 0) & (F.col("d.total") > 0), "count_disagrees")))
    page = paged(page.withColumn("next_url", clean(F.col("d.next_rest_url"))))
    rows = page.select("space_id", "source_label", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("d.events"))).alias("e"))
    venue = F.from_json("e.venue", VENUE)
    place = F.array_join(F.array_distinct(F.array_compact(F.array(*[clean(venue[c]) for c in ("venue", "address", "city")], F.coalesce(clean(venue["state"]), clean(venue["province"])), clean(venue["zip"])))), ", ")
    utc = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    whole = F.coalesce(F.col("e.all_day"), F.lit(False))
    day = lambda c: F.to_date(F.substring(F.col(c), 1, 10), "yyyy-MM-dd")
    text = lambda c: clean(html_unescape(F.col(c)))
    return finished(rows.select(
        "space_id", "source_label", "problem", F.col("e").isNotNull().alias("has_event"), F.col("e.id").cast("string").alias("source_uid"), text("e.title").alias("title"), whole.alias("all_day"),
        F.when(whole, day("e.start_date")).alias("start_date"), F.when(whole, day("e.end_date")).alias("end_date"), F.when(~whole, utc("e.utc_start_date")).alias("start_instant"), F.when(~whole, utc("e.utc_end_date")).alias("end_instant"),
        F.col("e.timezone").alias("tz"), F.col("e.timezone").alias("source_tz"), F.when(whole, "date").otherwise("utc").alias("dtstart_form"), (F.datediff(day("e.end_date"), day("e.start_date")) + 1).alias("days"), F.nullif(place, F.lit("")).alias("location"),
        clean(strip_tags(text("e.description"))).alias("description"), F.col("e.url").alias("url"), clean(F.col("e.cost")).alias("price"), F.when(F.col("e.status") == "publish", "CONFIRMED").when(F.col("e.status") == "canceled", "CANCELLED").otherwise(F.upper("e.status")).alias("status"),
        ordered_distinct(F.concat(F.coalesce(F.transform("e.categories", lambda c: c["name"]), F.array().cast("array<string>")), F.coalesce(F.transform("e.tags", lambda c: c["name"]), F.array().cast("array<string>")))).alias("categories"), utc("e.modified_utc").alias("newest_change"),
    ), today, horizon_days)


@dataclass(frozen=True)
class Shape:
    """Where an item's fields lie (paths of VARIANT); starts: an array path or a single value. items: None to look for the list (discovered)."""

    items: str | None
    uid: str
    title: str
    starts: str
    keyed: bool = False
    start_format: str = "iso"
    description: str | None = None
    url: str | None = None
    price: str | None = None
    location: str | None = None
    categories: tuple[str, ...] = ()
    zone: str = "America/Los_Angeles"
    total: str | None = None
    sentinels: tuple[str, ...] = field(default=("tbd", "tba", "n/a"))


def _path(v: Column, path: str | None, kind: str = "string") -> Column:
    return F.try_variant_get(v, "$" if path == "" else f"$.{path}" if not path.startswith("[") else f"${path}", kind) if path is not None else F.lit(None).cast(kind)


def started(c: Column, form: str, zone: str) -> dict[str, Column]:
    """start_instant or start_local of a text: ISO 8601, epoch seconds or milliseconds, or US short; years 1990 to 2040."""
    if form in ("epoch", "epoch_ms"):
        return {"start_instant": epoch_instant(c, form == "epoch_ms"), "start_local": F.lit(None).cast("timestamp_ntz")}
    if form == "us_short":
        return {"start_instant": F.lit(None).cast("timestamp"), "start_local": us_short(c)}
    zoned = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    sane = lambda at: F.when(F.year(at).between(1990, 2040), at)
    return {"start_instant": F.when(zoned, sane(F.try_to_timestamp(c))), "start_local": F.when(~zoned, sane(F.try_to_timestamp(c)).cast("timestamp_ntz"))}


def discovered(doc: Column) -> Column:
    """The items of a document whose list has no declared path: the document itself if it is a list of objects, else its first top-level value that is one."""
    listed = r"^\s*\[\s*\{"
    values = F.map_values(F.from_json(doc, "map<string,string>"))
    inner = F.get(F.filter(values, lambda v: v.rlike(listed)), F.lit(0))
    return F.try_variant_get(F.try_parse_json(F.when(doc.rlike(listed), doc).otherwise(inner)), "$", "array<variant>")


def read_items(documents: DataFrame, shape: Shape, today: dt.date, horizon_days: int) -> DataFrame:
    """PARSED rows of documents (space_id, source_label, problem, doc string) of a declared shape: one per start value of each item."""
    parsed = documents.withColumn("v", F.try_parse_json("doc"))
    parsed = parsed.withColumn("problem", F.coalesce("problem", F.when(F.col("v").isNull(), "unparseable")))
    where = _path(F.col("v"), shape.items, "map<string,variant>" if shape.keyed else "array<variant>") if shape.items is not None else discovered(F.col("doc"))
    total = _path(F.col("v"), shape.total, "bigint")
    parsed = parsed.withColumn("_items", F.map_values(where) if shape.keyed else where)
    empty_but = (F.size("_items") == 0) & (F.coalesce(total, F.lit(0)) > 0)
    parsed = parsed.withColumn("problem", F.coalesce("problem", F.when(F.col("_items").isNull(), "unexpected_shape").when(empty_but, "count_disagrees")))
    items = parsed.select("space_id", "source_label", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("_items"))).alias("i"))
    several = F.coalesce(_path(F.col("i"), shape.starts, "array<string>"), F.array_compact(F.array(_path(F.col("i"), shape.starts))))
    usable = F.filter(several, lambda s: ~F.lower(F.trim(s)).isin(*shape.sentinels))
    starts = items.withColumn("_s", F.explode_outer(usable))
    text = lambda p: clean(html_unescape(_path(F.col("i"), p)))
    labels = F.array(*[text(c) for c in shape.categories]) if shape.categories else F.array().cast("array<string>")
    return finished(starts.select(
        "space_id", "source_label", "problem", F.col("i").isNotNull().alias("has_event"), _path(F.col("i"), shape.uid).alias("source_uid"), text(shape.title).alias("title"), F.lit(False).alias("all_day"),
        *[v.alias(k) for k, v in started(F.col("_s"), shape.start_format, shape.zone).items()], F.lit(shape.zone).alias("tz"), F.lit({"iso": "offset", "us_short": "local"}.get(shape.start_format, "epoch")).alias("dtstart_form"), (F.size(usable) > 1).alias("recurring"),
        strip_tags(text(shape.description)).alias("description"), _path(F.col("i"), shape.url).alias("url"), money(_path(F.col("i"), shape.price, "double")).alias("price"), text(shape.location).alias("location"), ordered_distinct(labels).alias("categories"),
    ), today, horizon_days)


def read_json(payloads: DataFrame, today: dt.date, horizon_days: int = 120, shape: Shape | None = None, required: tuple[str, ...] = (), min_total: int | None = None) -> DataFrame:
    """Standalone documents of a declared shape. required: parameters the request must carry; min_total: least total header of a whole catalog."""
    problem = guard(JSON, _looks_json(), "not_json")
    for name in required:
        key = name.split("=")[0]
        said = F.try_parse_url(F.col("url"), F.lit("QUERY"), F.lit(key))
        held = said == name.split("=", 1)[1] if "=" in name else said.isNotNull()
        problem = F.coalesce(problem, F.when(~F.coalesce(held, F.lit(False)), "missing_parameter"))
    if min_total is not None:
        total = F.expr("try_cast(headers['x-wp-total'] AS BIGINT)")
        problem = F.coalesce(problem, F.when(total.isNull(), "no_total").when(total < min_total, "truncated_catalog"))
    docs = payloads.select("space_id", "source_label", problem.alias("problem"), text_body().alias("doc"))
    return read_items(docs, shape, today, horizon_days)


PRODUCT = "id bigint, name string, permalink string, description string, short_description string, prices struct<price:string,currency_minor_unit:int,currency_prefix:string,price_range:struct<min_amount:string,max_amount:string>>, attributes array<struct<name:string,taxonomy:string,terms:array<struct<id:bigint,name:string,slug:string>>>>, categories array<struct<name:string>>"


def read_products(payloads: DataFrame, today: dt.date, horizon_days: int = 120, taxonomy: str = "pa_date", start_format: str = "us_short", zone: str = "America/Los_Angeles") -> DataFrame:
    """Shop product lists whose dates are terms of an attribute: one occurrence per term."""
    docs = payloads.select("space_id", "source_label", guard(JSON, _looks_json(), "not_json").alias("problem"), F.from_json(text_body(), f"array<struct<{PRODUCT.replace(' bigint', ':bigint').replace(' string', ':string').replace(' struct<', ':struct<').replace(' array<', ':array<')}>>").alias("d"))
    docs = docs.withColumn("problem", F.coalesce("problem", F.when(F.col("d").isNull(), "unexpected_shape")))
    rows = docs.select("space_id", "source_label", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("d"))).alias("p"))
    dates = F.flatten(F.transform(F.filter("p.attributes", lambda a: (a["taxonomy"] == taxonomy) | (F.lower(a["name"]) == taxonomy)), lambda a: a["terms"]))
    rows = rows.withColumn("_n", F.size(dates)).select("*", F.explode_outer(dates).alias("t"))
    amount = lambda c: F.expr(f"try_cast({c} AS DECIMAL(20,4))")
    price = minor_unit_price(F.coalesce(amount("p.prices.price_range.min_amount"), amount("p.prices.price")), amount("p.prices.price_range.max_amount"), F.coalesce("p.prices.currency_minor_unit", F.lit(2)))
    return finished(rows.select(
        "space_id", "source_label", "problem", F.col("p").isNotNull().alias("has_event"), F.concat_ws("-", F.col("p.id").cast("string"), F.col("t.id").cast("string")).alias("source_uid"), clean(html_unescape(F.col("p.name"))).alias("title"), F.lit(False).alias("all_day"),
        *[v.alias(k) for k, v in started(F.col("t.name"), start_format, zone).items()], F.lit(zone).alias("tz"), F.lit("local").alias("dtstart_form"), strip_tags(html_unescape(F.coalesce(clean(F.col("p.short_description")), F.col("p.description")))).alias("description"),
        F.col("p.permalink").alias("url"), price.alias("price"), ordered_distinct(F.transform("p.categories", lambda c: c["name"])).alias("categories"),
    ), today, horizon_days)


def script_json(document: Column, script_id: str) -> Column:
    """The text of the JSON script element with that id."""
    return F.nullif(F.regexp_extract(document, rf'(?is)<script\b(?=[^>]*\bid\s*=\s*["\']{script_id}["\'])[^>]*>(.*?)</script>', 1), F.lit(""))


def read_embedded(payloads: DataFrame, today: dt.date, horizon_days: int = 120, script_id: str = "data", shape: Shape | None = None) -> DataFrame:
    """A JSON blob in a named script element of a page."""
    blob = script_json(text_body(), script_id)
    problem = F.coalesce(guard(HTML, F.coalesce(F.contains(F.lower(text_body()), F.lit("<script")), F.lit(False)), "not_html"), F.when(blob.isNull(), "no_blob"))
    return read_items(payloads.select("space_id", "source_label", problem.alias("problem"), blob.alias("doc")), shape, today, horizon_days)


#: Where a page's props hold an organizer's events, and the parts that make up an address.
PROPS, ADDRESS = "props.pageProps", ("address_1", "address_2", "city", "region", "postal_code")
DEFAULT_ZONE = "America/Los_Angeles"


def assembled_start(item: Column) -> Column:
    """The wall clock of start_date and start_time; a date alone is none; start.local where these two are not given."""
    day, time = clean(_path(item, "start_date")), clean(_path(item, "start_time"))
    return F.coalesce(F.concat(day, F.lit("T"), time), clean(_path(item, "start.local")))


def venue_text(item: Column) -> Column:
    """primary_venue: its address as a text, as a display line, as several, or from its parts; else its name."""
    at = lambda p: clean(_path(item, f"primary_venue.{p}"))
    joined = lambda parts: F.nullif(F.array_join(F.array_compact(parts), ", "), F.lit(""))
    plain = F.when(F.schema_of_variant(F.try_variant_get(item, "$.primary_venue.address", "variant")) == "STRING", at("address"))
    lines = F.transform(_path(item, "primary_venue.address.localized_multi_line_address_display", "array<string>"), clean)
    return F.coalesce(plain, at("address.localized_address_display"), joined(lines), joined(F.array(*[at(f"address.{p}") for p in ADDRESS])), at("name"))


def read_nextdata(payloads: DataFrame, today: dt.date, horizon_days: int = 120) -> DataFrame:
    """An organizer's upcoming events in a page's __NEXT_DATA__ blob.

    Problems: no_events_key, no_total, count_disagrees (one of the list and its
    total is empty and the other isn't) and no_dates (items, but no usable start).
    A total of zero with an empty list is an answer and no problem.
    """
    blob = script_json(text_body(), "__NEXT_DATA__")
    problem = F.coalesce(guard(HTML, F.coalesce(F.contains(F.lower(text_body()), F.lit("<script")), F.lit(False)), "not_html"), F.when(blob.isNull(), "no_blob"))
    pages = payloads.select("space_id", "source_label", problem.alias("problem"), F.try_parse_json(blob).alias("v"))
    items, total = _path(F.col("v"), f"{PROPS}.upcomingEvents", "array<variant>"), F.when(F.schema_of_variant(F.try_variant_get("v", f"$.{PROPS}.upcomingEventsTotal", "variant")) == "BIGINT", _path(F.col("v"), f"{PROPS}.upcomingEventsTotal", "bigint"))
    pages = pages.withColumns({"_items": items, "_total": total})
    apart = (F.col("_total") != F.size("_items")) & ((F.size("_items") == 0) | (F.col("_total") == 0))
    start = lambda i: F.try_to_timestamp(assembled_start(i))
    sane = lambda i: F.coalesce(F.year(start(i)).between(1990, 2040), F.lit(False))
    undated = (F.size("_items") > 0) & ~F.exists("_items", sane)
    pages = pages.withColumn("problem", F.coalesce("problem", F.when(F.col("v").isNull(), "unparseable").when(F.col("_items").isNull(), "no_events_key").when(F.col("_total").isNull(), "no_total").when(apart, "count_disagrees").when(undated, "no_dates")))
    rows = pages.select("space_id", "source_label", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("_items"))).alias("i"))
    item, zone = F.col("i"), clean(_path(F.col("i"), "timezone"))
    tz = F.when(zone.isin(*sorted(zoneinfo.available_timezones())), zone).otherwise(DEFAULT_ZONE)
    first = lambda *paths: F.coalesce(*[clean(html_unescape(F.when(F.schema_of_variant(F.try_variant_get(item, f"$.{p}", "variant")) == "STRING", _path(item, p)))) for p in paths])
    return finished(rows.select(
        "space_id", "source_label", "problem", item.isNotNull().alias("has_event"), _path(item, "id").alias("source_uid"), first("name.text", "name", "title").alias("title"), F.lit(False).alias("all_day"),
        F.when(sane(item), F.to_utc_timestamp(start(item), tz)).alias("start_instant"), tz.alias("tz"), F.lit("tzid").alias("dtstart_form"), F.lit(False).alias("recurring"),
        strip_tags(first("summary", "description.text", "description")).alias("description"), _path(item, "url").alias("url"), venue_text(item).alias("location"),
    ), today, horizon_days)


ADAPTERS |= {"tribe_rest": read_tribe, "json": read_json, "products": read_products, "embedded_json": read_embedded, "nextdata": read_nextdata}
