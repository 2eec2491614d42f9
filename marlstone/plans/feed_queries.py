"""Queries of the readers, sinks and state operators: feeds are written from the driver's tables, read by the engine, and SQL says what must come out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import identity, text, times
from marlstone.functions.fuzzy import address_similarity, entities_decoded
from marlstone.operators import gates, normalize, resolve, rules, state
from marlstone.plans.queries import HISTORY, NOW, RECORDS, _history, _records, instant, query, read
from marlstone.schemas import RAW_EVENT
from marlstone.sinks import calendar, feed, health
from marlstone.sources import events_of, feeds, jsondocs, markup, payloads, read_source, registry, reports_of
from marlstone.sources.base import CALENDAR, guard

TODAY, DAYS = dt.date(2024, 1, 1), 30


def landed(rows: DataFrame, body: Column | str, kind: str | Column, status: Column | int = 200, url: Column | str = "https://example.org/feed") -> DataFrame:
    """rows (space_id, source_label, ..) as answered payloads."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select(
        F.col("space_id").cast("string").alias("space_id"), F.col("source_label").cast("string").alias("source_label"), lit(url).alias("url"), lit(status).cast("int").alias("status"), lit(kind).alias("content_type"),
        F.create_map().cast("map<string,string>").alias("headers"), lit(body).cast("string").cast("binary").alias("body"), F.lit("fetched").alias("outcome"), F.lit(NOW).cast("timestamp").alias("fetched_at"),
    )


def joined(rows: DataFrame, by: list[str], order: str, piece: Column, separator: str) -> DataFrame:
    """One text a group: pieces in order of a whole number, put together by stretches of it first, so that a long text is not held as so many objects."""
    text_of = lambda of: F.array_join(F.transform(F.sort_array(F.collect_list(of)), lambda x: x["p"]), separator)
    stretches = rows.withColumn("_o", F.floor(F.col(order) / 4096)).groupBy(*by, "_o").agg(text_of(F.struct(F.col(order).alias("o"), piece.alias("p"))).alias("_p"))
    return stretches.groupBy(*by).agg(text_of(F.struct(F.col("_o").alias("o"), F.col("_p").alias("p"))).alias("body"))


def seconds(c: str | Column) -> Column:
    return F.unix_timestamp(F.col(c) if isinstance(c, str) else c)


def shown(c: Column, form: str) -> Column:
    return F.date_format(c, form)


# ---------------------------------------------------------------- calendars


def _calendars(spark, sf_dir) -> DataFrame:
    """Orders as calendar entries, forty calendars: UTC times, whole days of two days, floating times, and unreadable ones."""
    o = read(spark, sf_dir, "orders")
    key, at = F.col("o_orderkey"), F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    stamp = shown(at, "yyyyMMdd'T'HHmmss")
    whole = F.concat(F.lit("DTSTART;VALUE=DATE:"), shown(F.col("o_orderdate"), "yyyyMMdd"), F.lit("\r\nDTEND;VALUE=DATE:"), shown(F.date_add(F.to_date("o_orderdate"), 2), "yyyyMMdd"))
    start = F.when(key % 17 == 0, "DTSTART:soon").when(key % 3 == 0, F.concat(F.lit("DTSTART:"), stamp, F.lit("Z"))).when(key % 3 == 1, whole).otherwise(F.concat(F.lit("DTSTART:"), stamp))
    lines = F.concat_ws("\r\n", F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:o"), key), F.concat(F.lit("SUMMARY:Order "), key, F.lit("\\, "), F.col("o_orderpriority")), start, F.concat(F.lit("LAST-MODIFIED:"), shown(F.col("o_orderdate"), "yyyyMMdd'T'000000'Z'")), F.concat(F.lit("CATEGORIES:"), F.col("o_orderstatus"), F.lit(",x")), F.concat(F.lit("CATEGORIES:"), F.col("o_orderstatus")), F.lit("END:VEVENT\r\n"))
    rows = o.withColumns({"space_id": F.lit("s"), "source_label": (F.col("o_custkey") % 40).cast("string")})
    bodies = joined(rows, ["space_id", "source_label"], "o_orderkey", lines, "")
    return landed(bodies, F.concat(F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:x\r\n"), F.col("body"), F.lit("END:VCALENDAR\r\n")), "text/calendar; charset=utf-8")


ORDERS = "(SELECT *, CAST(o_custkey % 40 AS VARCHAR) AS label, CAST(o_orderdate AS DATE) AS day, o_orderdate + to_hours(o_orderkey % 24) AS tm FROM orders)"
YEAR, SPAN = dt.date(1996, 1, 1), 365
IN_YEAR = "day BETWEEN date '1996-01-01' AND date '1996-12-31'"


@query(f"""SELECT label AS source_label, 'o' || o_orderkey AS source_uid, 'Order ' || o_orderkey || ', ' || o_orderpriority AS title, o_orderkey % 3 = 1 AS all_day, CASE o_orderkey % 3 WHEN 0 THEN 'utc' WHEN 1 THEN 'date' ELSE 'floating' END AS dtstart_form,
  CASE WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END AS days, CASE WHEN o_orderkey % 3 = 1 THEN strftime(day, '%Y-%m-%d') ELSE strftime(tm, '%Y-%m-%d %H:%M:%S') END AS start, CASE WHEN o_orderkey % 3 = 1 THEN strftime(day + 1, '%Y-%m-%d') END AS last_day, o_orderstatus || ',x' AS categories
FROM {ORDERS} WHERE o_orderkey % 17 <> 0 AND {IN_YEAR}""")
def calendar_events(spark, sf_dir):
    """Calendars read, clipped to a year: forms, exclusive ends, categories in order."""
    e = events_of(read_source("ics", _calendars(spark, sf_dir), YEAR, SPAN))
    time = F.coalesce(F.date_format("start_local", "yyyy-MM-dd HH:mm:ss"), F.date_format("start_instant", "yyyy-MM-dd HH:mm:ss"))
    return e.select("source_label", "source_uid", "title", "all_day", "dtstart_form", "days", F.coalesce(F.date_format("start_date", "yyyy-MM-dd"), time).alias("start"), F.date_format("end_date", "yyyy-MM-dd").alias("last_day"), F.array_join("categories", ",").alias("categories"))


@query(f"""SELECT label AS source_label, count(*) FILTER (WHERE o_orderkey % 17 <> 0 AND {IN_YEAR}) AS horizon_count, count(*) FILTER (WHERE o_orderkey % 17 = 0) AS undated_count, CAST(epoch(max(day)) AS BIGINT) AS newest_change FROM {ORDERS} GROUP BY label""")
def calendar_reports(spark, sf_dir):
    """A verdict row per calendar: counts in the horizon and without a date, and the newest change."""
    r = reports_of(read_source("ics", _calendars(spark, sf_dir), YEAR, SPAN))
    return r.where("problem is null").select("source_label", "horizon_count", F.col("undated_count").cast("long").alias("undated_count"), seconds("newest_change").alias("newest_change"))


KINDS = ["text/calendar", "text/html; charset=utf-8", "application/octet-stream", "text/x-vcalendar", "", "Text/Calendar;x=1"]


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 4 = 1 OR c_nationkey % 4 = 3 THEN 'http_error' WHEN c_custkey % 5 = 0 THEN 'empty_body' WHEN c_custkey % 6 = 1 THEN 'wrong_content_type' WHEN c_custkey % 6 IN (2, 4) AND c_custkey % 5 = 1 THEN 'wrong_content_type' WHEN c_custkey % 5 = 1 THEN 'not_calendar' END AS problem FROM customer""")
def payload_guard(spark, sf_dir):
    """Transport, type and first bytes of calendar payloads."""
    c = read(spark, sf_dir, "customer").withColumns({"space_id": F.col("c_custkey"), "source_label": F.lit("l")})
    body = F.when(F.col("c_custkey") % 5 == 0, "").when(F.col("c_custkey") % 5 == 1, "hello").otherwise("BEGIN:VCALENDAR")
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), (F.col("c_custkey") % 6).cast("int"))
    status = F.get(F.array(*[F.lit(n) for n in (200, 404, 204, 500)]), (F.col("c_nationkey") % 4).cast("int"))
    sniff = F.contains(F.substring(F.decode("body", "UTF-8"), 1, 4096), F.lit("BEGIN:VCALENDAR"))
    return landed(c, body, kind, status).select(F.col("space_id").cast("long").alias("c_custkey"), guard(CALENDAR, sniff, "not_calendar").alias("problem"))


@query("""SELECT a.c AS actual, e.c AS expected, a.c = e.c OR (e.c LIKE '%/*' AND starts_with(a.c, regexp_replace(e.c, '\\*$', ''))) OR ends_with(a.c, '+' || regexp_replace(e.c, '^.*/', '')) AS fits
FROM (SELECT DISTINCT lower(trim(split_part(k, ';', 1))) AS c FROM (VALUES ('text/html; q=1'), ('APPLICATION/LD+JSON'), ('application/json'), ('image/svg+xml'), ('text/x')) v(k), region) a, (VALUES ('text/*'), ('application/json'), ('application/xml'), ('text/html')) e(c)""")
def content_types(spark, sf_dir):
    """Types that answer for others: equal, by wildcard, by suffix."""
    kinds = read(spark, sf_dir, "region").select(F.explode(F.array(*[F.lit(k) for k in ("text/html; q=1", "APPLICATION/LD+JSON", "application/json", "image/svg+xml", "text/x")])).alias("k")).select(text.content_type(F.col("k")).alias("actual")).distinct()
    both = kinds.select("actual", F.explode(F.array(*[F.lit(k) for k in ("text/*", "application/json", "application/xml", "text/html")])).alias("expected"))
    return both.select("actual", "expected", text.content_type_matches(F.col("actual"), F.col("expected")).alias("fits"))


# ---------------------------------------------------------------- REST pages


@query("""SELECT p_brand AS source_label, CAST(p_partkey AS VARCHAR) AS source_uid, p_name || ' & co' AS title, CASE WHEN p_partkey % 4 = 0 THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status, p_partkey % 3 = 0 AS all_day, CAST(p_size % 3 + 1 AS INTEGER) AS days,
  'Hall ' || p_brand || ', ' || p_size || ' Main St, Alameda, CA' AS location, '$' || p_size AS price, p_type || ',New' AS categories, CAST(epoch(date '2024-01-01' + p_size + CASE WHEN p_partkey % 3 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END) AS BIGINT) AS start FROM part WHERE p_size <= 30""")
def rest_events(spark, sf_dir):
    """Events-calendar pages: entities, venues, statuses, all-day spans, categories and tags."""
    p = read(spark, sf_dir, "part").withColumns({"space_id": F.lit("s"), "source_label": F.col("p_brand")})
    first = F.date_add(F.lit(TODAY), F.col("p_size"))
    day, last = shown(first, "yyyy-MM-dd"), shown(F.date_add(first, F.col("p_size") % 3), "yyyy-MM-dd")
    event = F.struct(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 4 == 0, "canceled").otherwise("publish").alias("status"), F.lit("https://example.org/x").alias("url"), F.concat("p_name", F.lit(" &amp; co")).alias("title"), F.lit("<p>text</p>").alias("description"), (F.col("p_partkey") % 3 == 0).alias("all_day"),
        F.concat(day, F.lit(" 04:00:00")).alias("start_date"), F.concat(last, F.lit(" 06:00:00")).alias("end_date"), F.concat(day, F.lit(" 12:00:00")).alias("utc_start_date"), F.concat(last, F.lit(" 14:00:00")).alias("utc_end_date"), F.lit("America/Los_Angeles").alias("timezone"), F.concat(F.lit("$"), "p_size").alias("cost"),
        F.struct(F.concat(F.lit("Hall "), "p_brand").alias("venue"), F.concat("p_size", F.lit(" Main St")).alias("address"), F.lit("Alameda").alias("city"), F.lit(" ").alias("state"), F.lit("CA").alias("province")).alias("venue"), F.array(F.struct(F.col("p_type").alias("name"))).alias("categories"), F.array(F.struct(F.lit("New").alias("name")), F.struct(F.col("p_type").alias("name"))).alias("tags"),
    )
    pages = joined(p, ["space_id", "source_label"], "p_partkey", F.to_json(event), ",")
    e = events_of(read_source("tribe_rest", landed(pages, F.concat(F.lit('{"events": ['), F.col("body"), F.lit('], "total": 9}')), "application/json"), TODAY, DAYS))
    return e.select("source_label", "source_uid", "title", "status", "all_day", "days", "location", "price", F.array_join("categories", ",").alias("categories"), F.coalesce(seconds("start_instant"), F.datediff("start_date", F.lit(dt.date(1970, 1, 1))).cast("long") * 86400).alias("start"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS source_label, CASE n_nationkey % 6 WHEN 1 THEN 'runaway_pagination' WHEN 2 THEN 'missing_page' WHEN 3 THEN 'http_error' WHEN 4 THEN 'runaway_pagination' WHEN 5 THEN NULL END AS problem, CASE n_nationkey % 6 WHEN 0 THEN 2 WHEN 5 THEN 1 ELSE 0 END::BIGINT AS events FROM nation""")
def rest_pages(spark, sf_dir):
    """Pages of a catalog stand or fall together: two good ones, a loop, a page not landed, one that failed, too many, a single one."""
    n = read(spark, sf_dir, "nation").withColumn("kind", F.col("n_nationkey") % 6)
    many = F.when(F.col("kind") == 4, 22).when(F.col("kind").isin(2, 5), 1).otherwise(2)
    pages = n.select(F.lit("s").alias("space_id"), F.col("n_nationkey").alias("source_label"), "kind", many.alias("many"), F.explode(F.sequence(F.lit(1), many)).alias("page"))
    at = lambda page: F.concat(F.lit("https://example.org/"), F.col("source_label"), F.lit("?page="), page)
    following = F.when(F.col("page") < F.col("many"), at(F.col("page") + 1)).when(F.col("kind") == 1, at(F.lit(1))).when(F.col("kind") == 2, at(F.lit(2)))
    body = F.concat(F.lit('{"events": [{"id": '), F.col("page"), F.lit(', "title": "x", "utc_start_date": "2024-01-05 00:00:00"}], "total": 2'), F.coalesce(F.concat(F.lit(', "next_rest_url": "'), following, F.lit('"')), F.lit("")), F.lit("}"))
    parsed = read_source("tribe_rest", landed(pages, body, "application/json", F.when((F.col("kind") == 3) & (F.col("page") == 2), 500).otherwise(200), at(F.col("page"))), TODAY, DAYS)
    return reports_of(parsed).select("source_label", "problem", F.col("horizon_count").alias("events"))


# ---------------------------------------------------------------- RSS


def _channels(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumns({"space_id": F.lit("s"), "source_label": (F.col("o_custkey") % 20).cast("string")})
    key, at = F.col("o_orderkey"), F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    date = F.when(key % 3 == 0, F.concat(shown(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(key % 3 == 1, F.concat(shown(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise(F.concat(shown(at, "d MMM yyyy HH:mm:ss"), F.lit(" -0000")))
    item = F.concat(F.lit("<item><title> Order "), key, F.lit(" &amp; more</title><link>https://example.org/"), key, F.lit("</link>"), F.when(key % 2 == 0, F.concat(F.lit("<guid>g"), key, F.lit("</guid>"))).otherwise(""), F.lit("<pubDate>"), date, F.lit("</pubDate><category>"), F.col("o_orderstatus"), F.lit("</category><category> x</category><category>x</category></item>"))
    bodies = joined(o, ["space_id", "source_label"], "o_orderkey", item, "\n")
    return landed(bodies, F.concat(F.lit('<?xml version="1.0"?>\n<rss version="2.0"><channel><title>t</title>'), F.col("body"), F.lit("</channel></rss>")), "application/rss+xml")


GUID = "CASE WHEN o_orderkey % 2 = 0 THEN 'g' || o_orderkey ELSE 'https://example.org/' || o_orderkey END"
AT = "CAST(epoch(tm) AS BIGINT) - CASE WHEN o_orderkey % 3 = 1 THEN 7200 ELSE 0 END"


@query(f"""SELECT label AS source_label, {GUID} AS source_uid, 'Order ' || o_orderkey || ' & more' AS title, CASE WHEN o_orderkey % 3 = 2 THEN 'floating' ELSE 'offset' END AS dtstart_form, {AT} AS start, o_orderstatus || ',x' AS categories
FROM (SELECT * REPLACE (CAST(o_custkey % 20 AS VARCHAR) AS label) FROM {ORDERS})""")
def rss_events(spark, sf_dir):
    """Feeds whose dates are starts: RFC 822, RFC 3339 and -0000 dates, guids or links, categories in order."""
    e = read_source("rss", _channels(spark, sf_dir), dt.date(1990, 1, 1), 5000, mode="events").where("has_event")
    return e.select("source_label", "source_uid", "title", "dtstart_form", F.coalesce(seconds("start_instant"), seconds(F.col("start_local").cast("timestamp"))).alias("start"), F.array_join("categories", ",").alias("categories"))


@query(f"""SELECT label AS source_label, count(*) AS item_count, min({AT}) AS oldest, max({AT}) AS newest, substr(sha1(string_agg({GUID}, chr(10) ORDER BY o_orderkey)), 1, 16) AS digest FROM (SELECT * REPLACE (CAST(o_custkey % 20 AS VARCHAR) AS label) FROM {ORDERS}) GROUP BY label""")
def rss_liveness(spark, sf_dir):
    """Signs of life of change-detection feeds."""
    f = feeds.liveness(_channels(spark, sf_dir))
    return f.select("source_label", F.col("item_count").cast("long").alias("item_count"), seconds("oldest").alias("oldest"), seconds("newest").alias("newest"), "digest")


@query("""SELECT source_label, link, row_number() OVER (PARTITION BY source_label ORDER BY pos) AS nth FROM (SELECT CAST(c_nationkey AS VARCHAR) AS source_label, 'https://example.org/' || (c_custkey % 200) AS link, min(c_custkey) AS pos FROM customer WHERE c_custkey % 5 NOT IN (1, 2) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY source_label ORDER BY pos) <= 20""")
def seed_links(spark, sf_dir):
    """Pages that a seed feed names: distinct, of its host, no format= routes, at most twenty."""
    k = F.col("c_custkey")
    rest = F.concat(F.lit("/"), k % 200)
    link = F.when(k % 5 == 1, F.concat(F.lit("https://other.example.net"), rest)).when(k % 5 == 2, F.concat(F.lit("https://example.org"), rest, F.lit("?format=ical"))).otherwise(F.concat(F.lit("https://example.org"), rest))
    links = read(spark, sf_dir, "customer").select(F.lit("s").alias("space_id"), F.col("c_nationkey").cast("string").alias("source_label"), F.lit("https://Example.org/feed").alias("feed_url"), link.alias("link"), k.alias("pos"))
    return markup.seed_links(links).select("source_label", "link", F.col("nth").cast("long").alias("nth"))


# ---------------------------------------------------------------- pages


@query("""SELECT p_brand AS source_label, 'p' || p_partkey AS source_uid, p_name AS title, p_partkey % 3 = 0 AS all_day, CASE p_partkey % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'offset' ELSE 'floating' END AS dtstart_form, 'Hall, ' || p_size || ' Main St, Alameda' AS location,
  CASE WHEN p_size % 4 = 0 THEN 'Free' WHEN p_size % 4 = 1 THEN '$' || p_size ELSE '$5 - $' || (p_size + 10) END AS price, CASE WHEN p_partkey % 7 = 0 THEN 'CANCELLED' END AS status, CAST(epoch(date '2024-01-01' + p_size) AS BIGINT) + CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 43200 ELSE 36000 END AS start FROM part WHERE p_size <= 30""")
def jsonld_events(spark, sf_dir):
    """JSON-LD blocks of pages: graphs and lists walked through, events found at any depth, a broken block passed over."""
    p = read(spark, sf_dir, "part").withColumns({"space_id": F.lit("s"), "source_label": F.col("p_brand")})
    k, size, day = F.col("p_partkey"), F.col("p_size"), shown(F.date_add(F.lit(TODAY), F.col("p_size")), "yyyy-MM-dd")
    start = F.when(k % 3 == 0, day).when(k % 3 == 1, F.concat(day, F.lit("T10:00:00-02:00"))).otherwise(F.concat(day, F.lit("T10:00:00")))
    offers = F.when(size % 4 == 0, F.lit('{"price": "0"}')).when(size % 4 == 1, F.concat(F.lit('{"price": "'), size, F.lit('"}'))).otherwise(F.concat(F.lit('{"@type": "AggregateOffer", "lowPrice": "5", "highPrice": "'), size + 10, F.lit('", "priceCurrency": "USD"}')))
    kind = F.when(k % 2 == 0, F.lit('"MusicEvent"')).otherwise(F.lit('["Thing", "https://schema.org/Event"]'))
    event = F.concat(F.lit('{"@type": '), kind, F.lit(', "@id": "p'), k, F.lit('", "name": "'), F.col("p_name"), F.lit('", "startDate": "'), start, F.lit('", "location": {"@type": "Place", "name": "Hall", "address": {"streetAddress": "'), size, F.lit(' Main St", "addressLocality": "Alameda"}}, "offers": '), offers, F.when(k % 7 == 0, F.lit(', "eventStatus": "https://schema.org/EventCancelled"')).otherwise(""), F.lit("}"))
    inside = F.when(k % 4 == 0, F.concat(F.lit('{"@graph": ['), event, F.lit("]}"))).when(k % 4 == 1, F.concat(F.lit('{"@type": "ItemList", "itemListElement": [{"@type": "ListItem", "item": '), event, F.lit("}]}"))).otherwise(event)
    block = F.concat(F.lit('<script type="application/ld+json">'), inside, F.lit("</script>"))
    pages = joined(p, ["space_id", "source_label"], "p_partkey", block, "\n")
    e = events_of(read_source("jsonld", landed(pages, F.concat(F.lit('<html><script type="application/ld+json">{"broken": </script>'), F.col("body")), "text/html"), TODAY, DAYS))
    at = F.coalesce(seconds("start_instant"), seconds(F.col("start_local").cast("timestamp")), F.datediff("start_date", F.lit(dt.date(1970, 1, 1))).cast("long") * 86400)
    return e.select("source_label", "source_uid", "title", "all_day", "dtstart_form", "location", "price", "status", at.alias("start"))


@query("""SELECT n_name AS source_label, 'ev-s' || s_suppkey || '-' || strftime(date '2024-01-02' + CAST(s_suppkey % 28 AS INTEGER), '%Y%m%d') || '183000' AS source_uid, s_name AS title, 'Room ' || s_suppkey AS location, 'https://example.org/e/' || s_suppkey AS url, strftime(date '2024-01-02' + CAST(s_suppkey % 28 AS INTEGER), '%Y-%m-%d') || ' 18:30:00' AS start FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def agenda_rows(spark, sf_dir):
    """Agenda tables, as a page or in the string literals of a script that inserts it."""
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumns({"space_id": F.lit("s"), "source_label": F.col("n_name")})
    stamp = F.concat(shown(F.date_add(F.lit(dt.date(2024, 1, 2)), (F.col("s_suppkey") % 28).cast("int")), "yyyyMMdd"), F.lit("183000"))
    row = F.concat(F.lit("<tr data-hook='row' data-event='ev-s"), F.col("s_suppkey"), F.lit("-"), stamp, F.lit("'><td><a href='/e/"), F.col("s_suppkey"), F.lit("'><b>"), F.col("s_name"), F.lit("</b></a></td><td class='x location'>Room <i>"), F.col("s_suppkey"), F.lit("</i></td></tr>"))
    pages = joined(s, ["space_id", "source_label", "n_nationkey"], "s_suppkey", row, "\n")
    script = F.col("n_nationkey") % 2 == 1
    body = F.when(script, F.concat(F.lit('agenda.insert("<table class=\\"agenda\\">'), F.replace("body", F.lit("\n"), F.lit("\\n")), F.lit('</table>");'))).otherwise(F.concat(F.lit('<html><table class="agenda">'), F.col("body"), F.lit("</table>")))
    e = events_of(read_source("bookwhen_html", landed(pages, body, F.when(script, "text/javascript").otherwise("text/html")), TODAY, DAYS))
    return e.select("source_label", "source_uid", "title", "location", "url", shown(F.col("start_local"), "yyyy-MM-dd HH:mm:ss").alias("start"))


@query("""WITH s AS (SELECT n_name, n_nationkey % 6 AS k, s_suppkey, s_name, s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT n_name AS source_label, CASE k WHEN 1 THEN 'no_total' WHEN 2 THEN 'count_disagrees' WHEN 3 THEN 'no_events_key' WHEN 4 THEN 'no_dates' END AS problem, CASE WHEN k IN (0, 5) THEN CAST(s_suppkey AS VARCHAR) END AS source_uid, CASE WHEN k IN (0, 5) THEN s_name END AS title,
  CASE WHEN k IN (0, 5) THEN CASE WHEN s_suppkey % 3 = 0 THEN 'America/New_York' ELSE 'America/Los_Angeles' END END AS tz,
  CASE WHEN k IN (0, 5) THEN CASE s_suppkey % 5 WHEN 0 THEN '1 Main St, Alameda' WHEN 1 THEN '2 Main St, Alameda' WHEN 2 THEN '3 Main St, Alameda, CA' WHEN 3 THEN '4 Main St, Alameda, 94501' ELSE 'Hall' END END AS location,
  CASE WHEN k IN (0, 5) THEN 1705168800 + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 10800 END END AS start
FROM s WHERE k IN (0, 5) OR s_suppkey IN (SELECT min(s_suppkey) FROM s GROUP BY n_name)""")
def nextdata_events(spark, sf_dir):
    """Organizers' upcoming events in a page's blob: start of three fields, four shapes of address, and drift told from a true zero."""
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumns({"space_id": F.lit("s"), "source_label": F.col("n_name"), "k": F.col("n_nationkey") % 6})
    key = F.col("s_suppkey")
    address = (
        F.when(key % 5 == 0, '"address": " 1 Main St, Alameda"').when(key % 5 == 1, '"address": {"localized_address_display": "2 Main St, Alameda"}').when(key % 5 == 2, '"address": {"localized_multi_line_address_display": ["3 Main St", "Alameda", " ", "CA"]}')
        .when(key % 5 == 3, '"address": {"address_1": "4 Main St", "city": "Alameda", "postal_code": "94501"}').otherwise('"name": "Hall"')
    )
    zone = F.when(key % 3 == 0, '"timezone": "America/New_York", ').when(key % 3 == 1, '"timezone": "Nowhere/City", ').otherwise("")
    start = F.when(F.col("k") == 4, '"start_date": "2024-01-13", ').when(key % 2 == 0, '"start_date": "2024-01-13", "start_time": "13:00", ').otherwise('"start": {"local": "2024-01-13T13:00"}, ')
    item = F.concat(F.lit('{"id": "'), key, F.lit('", "name": '), F.when(key % 2 == 0, F.concat(F.lit('"'), F.col("s_name"), F.lit('"'))).otherwise(F.concat(F.lit('{"text": "'), F.col("s_name"), F.lit('"}'))), F.lit(", "), zone, start, F.lit('"primary_venue": {'), address, F.lit("}}"))
    pages = joined(s, ["space_id", "source_label", "k"], "s_suppkey", item, ",")
    listed = F.when(F.col("k") == 3, F.lit('"other": ')).otherwise('"upcomingEvents": ')
    total = F.when(F.col("k") == 1, "").when(F.col("k") == 2, ', "upcomingEventsTotal": 0').otherwise(', "upcomingEventsTotal": 99')
    blob = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props": {"pageProps": {'), listed, F.lit("["), F.col("body"), F.lit("]"), total, F.lit("}}}</script>"))
    parsed = read_source("nextdata", landed(pages, blob, "text/html"), TODAY, DAYS)
    return parsed.select("source_label", "problem", "source_uid", "title", F.when(F.col("problem").isNull(), F.col("tz")).alias("tz"), "location", seconds("start_instant").alias("start"))


@query("""SELECT p_brand AS source_label, p_partkey || '-' || t AS source_uid, p_name AS title, strftime(date '2024-01-01' + CAST(p_size % 25 + t AS INTEGER), '%Y-%m-%d') || ' 18:30:00' AS start,
  CASE WHEN p_partkey % 3 = 0 THEN 'Free' WHEN p_partkey % 3 = 1 THEN '$' || format('{:,.2f}', CAST(p_size AS DOUBLE) * 100) ELSE '$' || format('{:,.2f}', CAST(p_size AS DOUBLE)) || ' - $' || format('{:,.2f}', CAST(p_size AS DOUBLE) * 2) END AS price FROM part, range(3) r(t)""")
def product_dates(spark, sf_dir):
    """Shop products whose dates are terms of one attribute; prices and ranges in minor units."""
    p = read(spark, sf_dir, "part").withColumns({"space_id": F.lit("s"), "source_label": F.col("p_brand")})
    k = F.col("p_partkey")
    day = lambda i: shown(F.date_add(F.lit(TODAY), (F.col("p_size") % 25).cast("int") + i), "MM/dd/yy")
    terms = F.array(*[F.struct(F.lit(i).alias("id"), F.concat(day(i), F.lit(" 6:30 PM")).alias("name"), F.lit("x").alias("slug")) for i in range(3)])
    cents = lambda c: (c * 100).cast("string")
    both = F.when(k % 3 == 2, F.struct(cents(F.col("p_size")).alias("min_amount"), cents(F.col("p_size") * 2).alias("max_amount")))
    prices = F.struct(F.when(k % 3 == 0, "0").otherwise(cents(F.col("p_size") * 100)).alias("price"), F.lit(2).alias("currency_minor_unit"), F.lit("$").alias("currency_prefix"), both.alias("price_range"))
    other = F.struct(F.lit("Level").alias("name"), F.lit("pa_level").alias("taxonomy"), F.array(F.struct(F.lit(9).alias("id"), F.lit("01/02/24 9:00 AM").alias("name"), F.lit("x").alias("slug"))).alias("terms"))
    product = F.struct(k.alias("id"), F.col("p_name").alias("name"), F.lit("https://example.org").alias("permalink"), F.lit("<p>d</p>").alias("description"), prices.alias("prices"), F.array(other, F.struct(F.lit("Date").alias("name"), F.lit("pa_date").alias("taxonomy"), terms.alias("terms"))).alias("attributes"))
    pages = joined(p, ["space_id", "source_label"], "p_partkey", F.to_json(product), ",")
    e = events_of(read_source("products", landed(pages, F.concat(F.lit("["), F.col("body"), F.lit("]")), "application/json"), TODAY, DAYS))
    return e.select("source_label", "source_uid", "title", shown(F.col("start_local"), "yyyy-MM-dd HH:mm:ss").alias("start"), "price")


@query("""SELECT p_brand AS source_label, 'p' || p_partkey AS source_uid, p_name AS title, 1704067200 + (p_size % 20) * 86400 + t * 3600 AS start, true AS recurring FROM part, range(2) r(t)""")
def keyed_documents(spark, sf_dir):
    """Standalone documents keyed by item: an occurrence per start value, sentinels left out."""
    p = read(spark, sf_dir, "part").withColumns({"space_id": F.lit("s"), "source_label": F.col("p_brand")})
    epoch = lambda t: F.lit(1704067200) + (F.col("p_size") % 20) * 86400 + t * 3600
    item = F.concat(F.lit('"k'), F.col("p_partkey"), F.lit('": {"Id": "p'), F.col("p_partkey"), F.lit('", "Name": "'), F.col("p_name"), F.lit('", "starts": ["'), epoch(0), F.lit('", "TBD", "'), epoch(1), F.lit('"]}'))
    pages = joined(p, ["space_id", "source_label"], "p_partkey", item, ",")
    shape = jsondocs.Shape(items="items", keyed=True, uid="Id", title="Name", starts="starts", start_format="epoch", zone="UTC")
    got = read_source("json", landed(pages, F.concat(F.lit('{"items": {'), F.col("body"), F.lit("}}")), "application/json"), TODAY, DAYS, shape=shape)
    return events_of(got).select("source_label", "source_uid", "title", seconds("start_instant").alias("start"), "recurring")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS source_label, CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'missing_parameter' WHEN 2 THEN 'no_total' WHEN 3 THEN 'truncated_catalog' ELSE 'unexpected_shape' END AS problem FROM nation""")
def catalog_guards(spark, sf_dir):
    """What a whole catalog must show: its order parameter, its total header, enough items, the declared shape."""
    n = read(spark, sf_dir, "nation").withColumns({"space_id": F.lit("s"), "source_label": F.col("n_nationkey"), "k": F.col("n_nationkey") % 5})
    url = F.when(F.col("k") == 1, "https://example.org/x?orderby=name").otherwise("https://example.org/x?per_page=9&orderby=date")
    body = F.when(F.col("k") == 4, '{"else": []}').otherwise('{"items": []}')
    p = landed(n, body, "application/json", url=url).withColumn("headers", F.when(F.col("source_label").cast("int") % 5 == 2, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("x-wp-total"), F.when(F.col("source_label").cast("int") % 5 == 3, "3").otherwise("300"))))
    shape = jsondocs.Shape(items="items", uid="id", title="name", starts="start")
    return reports_of(read_source("json", p, TODAY, DAYS, shape=shape, required=("orderby=date",), min_total=200)).select("source_label", "problem")


@query(r"""SELECT page_id, coalesce(nullif(regexp_extract(html, '(?is)<script\b[^>]*>(.*?)</script>', 1), ''), '') AS blob FROM (SELECT page_id, regexp_replace('<p>x</p>' || coalesce('<script id="other">0</script>', '') || '<SCRIPT type="application/json" id=''data''>{"page": ' || page_id || '}</script>', '<script id="other">0</script>', '') AS html FROM pages)""")
def named_script(spark, sf_dir):
    """The JSON script element of one id among others of a page."""
    html = F.concat(F.lit('<p>x</p><script id="other">0</script><SCRIPT type="application/json" id=\'data\'>{"page": '), F.col("page_id"), F.lit("}</script>"))
    return read(spark, sf_dir, "pages").select("page_id", F.coalesce(jsondocs.script_json(html, "data"), F.lit("")).alias("blob"))


# ---------------------------------------------------------------- values


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 700000000 + p_partkey * 1000 END WHEN 1 THEN 1500000000 + p_partkey END AS epoch, CASE p_partkey % 4 WHEN 2 THEN strftime(date '2024-01-01' + CAST(p_size AS INTEGER), '%Y-%m-%d') || ' 18:05:00' END AS local_time FROM part""")
def start_values(spark, sf_dir):
    """Epoch seconds, milliseconds and US short dates within sane years, else null."""
    k = F.col("p_partkey")
    value = F.when(k % 8 == 0, k).when(k % 4 == 0, 700000000 + k * 1000).when(k % 4 == 1, (F.lit(1500000000) + k) * 1000)
    us = F.when(k % 4 == 2, F.concat(shown(F.date_add(F.lit(TODAY), F.col("p_size")), "M/d/yy"), F.lit(" 6:05 pm"))).otherwise("1/5/85 6:00 PM")
    both = F.coalesce(times.epoch_instant(F.when(k % 4 == 0, value)), times.epoch_instant(F.when(k % 4 == 1, value), millis=True))
    return read(spark, sf_dir, "part").select("p_partkey", seconds(both).alias("epoch"), shown(times.us_short(us), "yyyy-MM-dd HH:mm:ss").alias("local_time"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT) + 3600 * 9 + CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 5 * 3600 WHEN 2 THEN 7 * 3600 WHEN 3 THEN 0 WHEN 4 THEN -19800 ELSE 0 END END AS moment FROM orders""")
def feed_dates(spark, sf_dir):
    """RFC 822 with zone names, without weekday or seconds, RFC 3339, and text that is no date."""
    k, d = F.col("o_orderkey") % 7, F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(9))
    form = (
        F.when(k == 0, F.concat(shown(d, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(k == 1, F.concat(shown(d, "EEEE, d MMM yyyy HH:mm:ss"), F.lit(" EST"))).when(k == 2, F.concat(shown(d, "d MMM yyyy HH:mm"), F.lit(" PDT")))
        .when(k == 3, F.concat(shown(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(k == 4, F.concat(shown(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30"))).when(k == 5, F.concat(shown(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))).otherwise("next week")
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", seconds(times.feed_date(form)).alias("moment"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true' WHEN 3 THEN 'false' WHEN 4 THEN 'true' END AS said, nullif(trim(CASE c_custkey % 6 WHEN 5 THEN '  ' ELSE c_name END), '') AS name FROM customer""")
def permissive_values(spark, sf_dir):
    word = F.get(F.array(*[F.lit(x) for x in (" Yes", "0", "TRUE ", "off", "1", "maybe")]), (F.col("c_custkey") % 6).cast("int"))
    padded = F.when(F.col("c_custkey") % 6 == 5, "  ").otherwise(F.concat(F.lit(" \t"), "c_name", F.lit(" ")))
    return read(spark, sf_dir, "customer").select("c_custkey", text.permissive_bool(word).cast("string").alias("said"), text.clean(padded).alias("name"))


@query(r"SELECT p_partkey, lower(trim(regexp_replace(p_name, '\s+', ' ', 'g'))) || ' fi' AS title FROM part")
def title_compatible(spark, sf_dir):
    """Titles in full-width letters with ligatures and typographic marks, folded to what plain ones give."""
    plain, wide = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "".join(chr(0xFF21 + ord(c) - 65) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    name = F.concat(F.lit("“"), F.translate("p_name", plain, wide), F.lit("”_–!　ﬁ"))
    return read(spark, sf_dir, "part").select("p_partkey", text.normalize_title(name).alias("title"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'title_excludes' WHEN 1 THEN 'title_excludes' WHEN 2 THEN 'categories_exclude' WHEN 3 THEN 'title_excludes' END AS rule,
  CASE p_partkey % 5 WHEN 0 THEN 'Women&#8217;s' WHEN 1 THEN 'CAF&Eacute;' WHEN 2 THEN 'STRASSE' WHEN 3 THEN 'Saw & Plane' END AS pattern FROM part""")
def filter_forms(spark, sf_dir):
    """Patterns and texts in other cases and with entities of any name or number."""
    titles = F.get(F.array(*[F.lit(x) for x in ("the women’s hour", "caf&eacute; night", "open", "saw &amp;amp; &AMP; plane? saw &amp; plane", "open & free")]), (F.col("p_partkey") % 5).cast("int"))
    empty = F.array().cast("array<string>")
    f = F.struct(F.array(F.lit("Women&#8217;s"), F.lit("CAF&Eacute;"), F.lit("Saw & Plane"), F.lit("")).alias("title_excludes"), empty.alias("location_excludes"), F.array(F.lit("STRASSE")).alias("categories_exclude"), empty.alias("title_contains"), empty.alias("location_contains"), F.lit(True).alias("location_allow_when_missing"))
    p = read(spark, sf_dir, "part").select("p_partkey", titles.alias("title"), F.lit("Hall").alias("location_name"), F.when(F.col("p_partkey") % 5 == 2, F.array(F.lit("Lange Straße"))).alias("categories"), f.alias("filters"))
    return rules.judged(p).select("p_partkey", "rule", "pattern")


@query("""SELECT p_size AS source_label, count(*) FILTER (WHERE p_partkey % 3 = 0) AS kept_on_missing_location FROM part GROUP BY p_size""")
def kept_without_place(spark, sf_dir):
    empty = F.array().cast("array<string>")
    f = F.struct(*[empty.alias(r) for r in rules.RULES[:4]], F.array(F.lit("hall")).alias("location_contains"), F.lit(True).alias("location_allow_when_missing"))
    p = read(spark, sf_dir, "part").select(F.lit("s").alias("space_id"), F.col("p_size").alias("source_label"), F.col("p_name").alias("title"), F.when(F.col("p_partkey") % 3 > 0, "Hall").alias("location_name"), empty.alias("categories"), f.alias("filters"))
    return rules.kept_without_place(rules.judged(p)).select("source_label", "kept_on_missing_location")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'location_missing' WHEN p_partkey % 4 = 1 THEN 'location_contains' END AS rule FROM part""")
def location_missing(spark, sf_dir):
    """A location is asked for and its absence is not allowed; a bare URL counts as absent."""
    empty = F.array().cast("array<string>")
    f = F.struct(*[empty.alias(r) for r in rules.RULES[:4]], F.array(F.lit("HALL")).alias("location_contains"), F.lit(False).alias("location_allow_when_missing"))
    place = F.when(F.col("p_partkey") % 8 == 0, "https://example.org/hall").when(F.col("p_partkey") % 4 == 1, "Room").when(F.col("p_partkey") % 4 > 1, "Main hall")
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), place.alias("location_name"), empty.alias("categories"), f.alias("filters"))
    return rules.judged(p).select("p_partkey", "rule")


@query("""SELECT p_partkey, sha256(p_name || chr(31) || '20240101T000000Z' || chr(31) || '' || chr(31) || p_brand || chr(31) || coalesce(CASE WHEN p_size % 2 = 0 THEN p_type END, '') || chr(31) || '' || chr(31) || substr(repeat(p_name, 200), 1, 2000)) AS content_hash FROM part""")
def content_hash(spark, sf_dir):
    none = F.lit(None).cast("string")
    return read(spark, sf_dir, "part").select("p_partkey", identity.content_hash(F.col("p_name"), instant(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), F.lit(None).cast("timestamp"), F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")), none, F.repeat("p_name", F.lit(200))).alias("content_hash"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 3 END + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END + 1 AS richness FROM part""")
def richness(spark, sf_dir):
    """How many mergeable fields have a value: empty texts and lists have none."""
    k, some = F.col("p_partkey"), lambda c: F.when(F.col("p_partkey") % 2 == 1, c).otherwise(F.when(F.col("p_partkey") % 4 == 0, F.lit("")))
    p = read(spark, sf_dir, "part").select("p_partkey", instant(F.lit("2024-01-01").cast("timestamp_ntz")).alias("end_utc"), some(F.lit("Hall")).alias("location_name"), some(F.lit("1 Main St")).alias("address"), some(F.col("p_name")).alias("url"), F.lit(None).cast("string").alias("price"), F.lit("").alias("description"), F.when(k % 3 > 0, F.array("p_type")).otherwise(F.array().cast("array<string>")).alias("categories"), F.lit(None).cast("string").alias("summary_line"), F.lit(None).cast("string").alias("rrule"))
    return p.select("p_partkey", resolve.richness().alias("richness"))


@query("""SELECT a.s_suppkey AS l, b.s_suppkey AS r, CASE WHEN a.s_suppkey % 4 = 3 OR b.s_suppkey % 4 = 3 THEN 0.0 WHEN a.s_suppkey % 4 = 2 AND b.s_suppkey % 4 = 2 THEN 100.0 WHEN a.s_suppkey % 4 = 2 OR b.s_suppkey % 4 = 2 THEN 100.0 WHEN a.s_nationkey = b.s_nationkey THEN 100.0 ELSE 0.0 END AS score
FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey AND a.s_suppkey % 50 = b.s_suppkey % 50""")
def address_scores(spark, sf_dir):
    """Abbreviations fold, house numbers must agree, an address of one word is too vague."""
    n = F.col("s_nationkey")
    form = F.when(F.col("s_suppkey") % 4 == 0, F.concat(n, F.lit(" North Main Street, Oakland"))).when(F.col("s_suppkey") % 4 == 1, F.concat(n, F.lit(" n. main st oakland"))).when(F.col("s_suppkey") % 4 == 2, F.lit("N Main St Oakland")).otherwise("Oakland")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 50).alias("g"), form.alias("a"))
    kinds = s.select("g", "a").distinct()
    known = resolve.value_scores(kinds.join(kinds.select("g", F.col("a").alias("b")), "g"), address_similarity)
    # a block of the left meets all of its group, so that no group is one task's alone
    n, parts = resolve.spread(s), 16
    left = s.select("g", F.col("s_suppkey").alias("l"), "a", F.pmod(F.xxhash64("s_suppkey"), F.lit(parts)).alias("part")).repartition(n, "g", "part")
    right = s.select("g", F.col("s_suppkey").alias("r"), F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")).repartition(n, "g", "part")
    return left.join(right, ["g", "part"]).where("l < r").join(known, ["a", "b"]).select("l", "r", "score")


@query("SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '^ +| +$', '', 'g')), '') AS text FROM pages")
def html_text(spark, sf_dir):
    """Page text with whole entities decoded."""
    return read(spark, sf_dir, "pages").select("page_id", text.clean(entities_decoded(text.strip_tags(F.col("html")))).alias("text"))


# ---------------------------------------------------------------- horizon, order, gates, history


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) + 2 > date '2024-01-15' AND ts <= timestamp '2024-02-14 08:00:00' ELSE ts >= timestamp '2024-01-15 08:00:00' AND ts <= timestamp '2024-02-14 08:00:00' END AS inside FROM events""")
def carry_horizon(spark, sf_dir):
    """What may be republished: not over, and starting by midnight of the horizon's last day in its own zone."""
    e = read(spark, sf_dir, "events").select("event_id", instant(F.col("ts")).alias("start_utc"), (F.col("event_id") % 3 == 0).alias("all_day"), F.when(F.col("event_id") % 3 == 0, F.date_add(F.to_date("ts"), 1)).alias("end_date"), F.lit("America/Los_Angeles").alias("tz"))
    return e.select("event_id", state.within_horizon(F.lit(NOW), 30).alias("inside"))


@query(f"""WITH r AS (SELECT event_id AS run_id, event_id % 11 = 0 AS dry_run, CASE WHEN event_id % 5 = 0 THEN event_type END AS space_filter, CAST(floor(value) AS BIGINT) % 3 AS event_count, user_id FROM events)
SELECT user_id, max(run_id) AS previous_run_id, arg_max(event_count, run_id) AS previous_event_count FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY run_id DESC) AS n FROM r WHERE user_id BETWEEN 1 AND 5) WHERE n <= 14 AND n > 1 AND NOT dry_run AND space_filter IS NULL AND event_count > 0 GROUP BY user_id""")
def previous_total(spark, sf_dir):
    """The last comparable run among the newest fourteen: for five run logs, each its own."""
    e = read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("run_id"), (F.col("event_id") % 11 == 0).alias("dry_run"), F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("space_filter"), (F.floor("value").cast("long") % 3).alias("event_count"))
    newest = e.groupBy("user_id").agg(F.max("run_id").alias("newest"))
    out = None
    for user in range(1, 6):
        log = e.where(F.col("user_id") == user)
        tonight = newest.where(F.col("user_id") == user).first()
        got = state.previous_total(log, F.lit(tonight["newest"] if tonight else -1)).select(F.lit(user).cast("long").alias("user_id"), "previous_run_id", "previous_event_count")
        out = got if out is None else out.union(got)
    return out


@query(f"""SELECT run_id, bool_or(status = 'ok' AND ((source_key = 'error' AND coalesce(stale > 20, false)) OR (cur = 0 AND source_key <> 'view' AND coalesce(prev > 0, false)))) OR coalesce(sum(prev) > 0 AND sum(prev) > sum(cur) AND CAST(sum(prev) - sum(cur) AS DOUBLE) / sum(prev) > 0.4, false) AS blocked FROM {RECORDS} WHERE run_id IN (1, 5, 7, 12, 14) GROUP BY run_id""")
def run_verdicts(spark, sf_dir):
    """Whether a night is blocked: by a source's gate or by the global one, which comes first in the list."""
    r, out = _records(spark, sf_dir), None
    for night in (1, 5, 7, 12, 14):
        mine = r.where(F.col("run_id") == night)
        total = mine.agg(F.sum("horizon_count").alias("cur"), F.sum("previous_count").alias("prev")).select(gates.global_gate(F.col("cur"), F.col("prev"), F.lit(None).cast("string")).alias("reason"))
        one = gates.assembled(gates.source_verdicts(mine), total).select(F.lit(night).cast("long").alias("run_id"), "blocked")
        out = one if out is None else out.union(one)
    return out.join(r.select("run_id").distinct(), "run_id", "left_semi")


@query("""SELECT s_suppkey, s_suppkey % 2 = 0 OR s_nationkey % 2 = 0 AS allow_zero, s_nationkey % 3 = 0 AS ignore_count_drop, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 5 END, CASE WHEN s_nationkey % 2 = 1 THEN 9 END) AS max_stale_days FROM supplier""")
def health_switches(spark, sf_dir):
    """Switches of a source or of its space; the source's stale limit goes before the space's."""
    make = lambda zero, drop, stale: F.struct(zero.alias("allow_zero"), drop.alias("ignore_count_drop"), F.lit(None).cast("boolean").alias("require_nonzero_once"), stale.cast("int").alias("max_stale_days"))
    spaces = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("space_id"), make(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") % 3 == 0, F.when(F.col("n_nationkey") % 2 == 1, 9)).alias("health"))
    sources = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("space_id"), F.col("s_suppkey").alias("source_label"), make(F.col("s_suppkey") % 2 == 0, F.lit(None).cast("boolean"), F.when(F.col("s_suppkey") % 3 == 0, 5)).alias("health"))
    return gates.merged_health(spaces, sources).select(F.col("source_label").alias("s_suppkey"), "health.allow_zero", "health.ignore_count_drop", "health.max_stale_days")


@query("SELECT c_custkey FROM customer WHERE c_nationkey % 5 = 0")
def space_known(spark, sf_dir):
    """Events of known spaces carry the space's name; one of an unknown space would fail the run."""
    c = read(spark, sf_dir, "customer").where("c_nationkey % 5 = 0").select("c_custkey", F.col("c_nationkey").cast("string").alias("space_id"))
    spaces = read(spark, sf_dir, "nation").where("n_nationkey % 5 = 0").select(F.col("n_nationkey").cast("string").alias("space_id"), F.col("n_name").alias("name"), F.lit("https://example.org").alias("url"))
    return calendar.with_space(c, spaces).where("space_name is not null").select("c_custkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(epoch(o_orderdate) AS BIGINT) WHEN o_orderkey % 3 = 1 THEN 946684800 ELSE 978307200 END AS seen FROM orders""")
def first_sight(spark, sf_dir):
    """First sight from history, else from the event, else now."""
    o = read(spark, sf_dir, "orders")
    history = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("uid"), instant(F.col("o_orderdate")).alias("first_seen"))
    events = o.select(F.col("o_orderkey").alias("uid"), F.when(F.col("o_orderkey") % 3 < 2, F.timestamp_seconds(F.lit(946684800))).alias("first_seen"))
    return feed.first_seen(events, history, F.timestamp_seconds(F.lit(978307200))).select(F.col("uid").alias("o_orderkey"), seconds("seen_at").alias("seen"))


VEVENTS = r"""SELECT o_orderkey, sha256('BEGIN:VEVENT' || e || 'UID:o' || o_orderkey || e || 'DTSTAMP:20240116T000000Z' || e || CASE WHEN o_orderkey % 2 = 0 THEN 'DTSTART;VALUE=DATE:' || strftime(o_orderdate, '%Y%m%d') || e || 'DTEND;VALUE=DATE:' || strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d') ELSE 'DTSTART:' || strftime(o_orderdate, '%Y%m%dT%H%M%SZ') END || e
  || 'SUMMARY:[Space] A\, b\; ' || o_orderkey || e || 'DESCRIPTION:Text' || '\n\n' || 'Price: $5' || '\n' || 'Space — https://example.org/' || e || 'LOCATION:' || CASE WHEN o_orderkey % 5 = 0 THEN 'Hall' ELSE '1 Main St' END || e || 'URL:https://example.org/' || e || 'ORGANIZER;CN="Space":https://example.org/' || e || 'CATEGORIES:a\,b,c' || e || 'X-SPACE-ID:s' || e || 'X-SOURCE:l' || e || 'END:VEVENT' || e) AS digest
FROM (SELECT *, chr(13) || chr(10) AS e FROM orders)"""


@query(VEVENTS)
def calendar_entries(spark, sf_dir):
    """VEVENT texts: escapes, whole-day ends, the description with price and credit, the space's link where the event has none."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    e = o.select("o_orderkey", F.concat(F.lit("o"), k).alias("uid"), F.lit("s").alias("space_id"), F.lit("l").alias("source_label"), F.concat(F.lit("A, b; "), k).alias("title"), instant(F.col("o_orderdate")).alias("start_utc"), F.lit(None).cast("timestamp").alias("end_utc"), (k % 2 == 0).alias("all_day"), F.to_date("o_orderdate").alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.when(k % 5 > 0, "1 Main St").alias("address"), F.lit("Hall").alias("location_name"), F.lit("").alias("url"), F.lit("$5").alias("price"), F.lit(" Text ").alias("description"), F.array(F.lit("a,b"), F.lit("c")).alias("categories"))
    spaces = spark.createDataFrame([("s", "Space", "https://example.org/")], "space_id string, name string, url string")
    return calendar.rendered(e, spaces, F.lit(NOW)).select("o_orderkey", F.sha2("vevent", 256).alias("digest"))


@query("""SELECT o_orderkey, '[Space] Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'https://example.org/' ELSE 'https://example.org/' || o_orderkey END AS link, CASE WHEN o_orderkey % 2 = 0 THEN 'Line' ELSE 'Text' END || chr(10) || chr(10) || strftime(o_orderdate, '%A, %B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y, 12:00 AM') || chr(10) || 'Space — ' || CASE WHEN o_orderkey % 3 = 0 THEN 'https://example.org/' ELSE 'https://example.org/' || o_orderkey END AS description, 'c,d' AS categories FROM orders""")
def feed_entries(spark, sf_dir):
    """RSS items: the summary line before the description, the date in words, the link or the space's, categories in order."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    e = o.select("o_orderkey", F.concat(F.lit("o"), k).alias("uid"), F.lit("s").alias("space_id"), F.concat(F.lit("Order "), k).alias("title"), instant(F.col("o_orderdate")).alias("start_utc"), instant(F.col("o_orderdate")).alias("seen_at"), F.lit(False).alias("all_day"), F.lit("UTC").alias("tz"), F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.when(k % 3 > 0, F.concat(F.lit("https://example.org/"), k)).alias("url"), F.lit("").alias("price"), F.lit("Text").alias("description"), F.when(k % 2 == 0, "Line").alias("summary_line"), F.array(F.lit(" c"), F.lit("d"), F.lit(""), F.lit("c")).alias("categories"))
    spaces = spark.createDataFrame([("s", "Space", "https://example.org/")], "space_id string, name string, url string")
    return feed.rendered(e, spaces).select(F.substring("uid", 2, 99).cast("long").alias("o_orderkey"), "title", "link", "description", F.array_join("categories", ",").alias("categories"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%A, %B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') ELSE strftime(o_orderdate, '%A, %B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') || ' – ' || strftime(CAST(o_orderdate AS DATE) + 3, '%A, %B ') || day(CAST(o_orderdate AS DATE) + 3) || strftime(CAST(o_orderdate AS DATE) + 3, ', %Y') END AS days FROM orders")
def all_day_text(spark, sf_dir):
    first = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", times.all_day_text(first, F.when(F.col("o_orderkey") % 3 == 0, first).otherwise(F.date_add(first, 3))).alias("days"))


@query("""SELECT s_suppkey, s_suppkey % 4 = 2 AND s_suppkey % 3 > 0 AS run, CASE WHEN s_suppkey % 3 = 0 THEN 'disabled' WHEN s_suppkey % 4 = 0 OR s_suppkey % 4 = 1 THEN 'todo' WHEN s_suppkey % 4 = 3 THEN 'not_implemented' END AS skip_reason FROM supplier""")
def run_set(spark, sf_dir):
    """Which sources of the registry run, and why the others don't."""
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "supplier").select(k.alias("ordinal"), F.col("s_nationkey").cast("string").alias("space_id"), k.alias("source_label"), (k % 3 > 0).alias("enabled"), (k % 4 < 2).alias("todo"), F.when(k % 4 == 3, "llm_html").otherwise("ics").alias("adapter"))
    return registry.runnable(s).select(F.col("source_label").alias("s_suppkey"), "run", "skip_reason")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'not_modified' ELSE 'fetched' END AS outcome FROM part""")
def unchanged_payloads(spark, sf_dir):
    """Bodies whose digest is the stored one count as not modified."""
    p = read(spark, sf_dir, "part").withColumns({"space_id": F.lit("s"), "source_label": F.col("p_partkey")})
    got = landed(p, F.col("p_name"), "text/html").withColumn("source_key", F.col("source_label"))
    stored = p.where("p_partkey % 3 = 0").select(F.col("p_partkey").cast("string").alias("source_key"), F.sha2(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("old"), 256).alias("body_sha256"))
    return state.unchanged_payloads(got, stored).select(F.col("source_label").cast("long").alias("p_partkey"), "outcome")


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'ics' WHEN 1 THEN 'json' WHEN 2 THEN 'xml' WHEN 3 THEN 'json' ELSE 'bin' END AS extension FROM customer")
def archive_names(spark, sf_dir):
    kind = F.get(F.array(*[F.lit(x) for x in ("Text/Calendar; charset=x", "application/ld+json", "application/rss+xml", "application/json", "image/png")]), (F.col("c_custkey") % 5).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", payloads.extension(kind).alias("extension"))


@query("""SELECT c_mktsegment AS source_label, CASE c_mktsegment WHEN 'BUILDING' THEN 'not_implemented' ELSE 'unknown_adapter' END AS problem, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def missing_adapters(spark, sf_dir):
    """Sources whose adapter is unknown or not available say so, and give no event."""
    c = read(spark, sf_dir, "customer").withColumns({"space_id": F.lit("s"), "source_label": F.col("c_mktsegment")})
    got = None
    for adapter, rows in (("llm_html", c.where("c_mktsegment = 'BUILDING'")), ("other", c.where("c_mktsegment <> 'BUILDING'"))):
        parsed = read_source(adapter, landed(rows, F.lit("x"), "text/html"), TODAY, DAYS)
        got = parsed if got is None else got.unionByName(parsed)
    return got.where("not has_event").groupBy("source_label", "problem").agg(F.count("*").alias("n"))


@query("""SELECT r_name AS category, n_name AS interest, lower(n_name || 's') AS keyword FROM region JOIN nation ON n_regionkey = r_regionkey UNION ALL SELECT r_name, n_name, 'shared' FROM region JOIN nation ON n_regionkey = r_regionkey""")
def taxonomy_keywords(spark, sf_dir):
    """A taxonomy document of categories, interests and keywords as rows."""
    from marlstone.sources import taxonomy

    interest = F.struct(F.col("n_name").alias("name"), F.array(F.concat("n_name", F.lit("s")), F.lit(" Shared "), F.lit("shared")).alias("keywords"))
    both = read(spark, sf_dir, "region").join(read(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.collect_list(interest).alias("interests"))
    documents = both.select(F.to_json(F.array(F.struct(F.col("r_name").alias("name"), F.lit("x").alias("description"), "interests"))).alias("doc"))
    return taxonomy.keywords(documents, F.col("doc"))


@query("""SELECT p_brand AS source_label, CAST(p_partkey AS VARCHAR) AS source_uid FROM part WHERE p_partkey % 4 <> 3""")
def discovered_items(spark, sf_dir):
    """Items of documents whose list has no declared path: the root, the first list of objects, or none."""
    p = read(spark, sf_dir, "part")
    item = F.concat(F.lit('[{"id": "'), F.col("p_partkey"), F.lit('", "name": "x", "start": "2024-01-05T10:00:00"}]'))
    k = F.col("p_partkey") % 4
    doc = F.when(k == 0, item).when(k == 1, F.concat(F.lit('{"z": [1, 2], "empty": [], "items": '), item, F.lit(', "a": [{"id": "later"}]}'))).when(k == 2, F.concat(F.lit('{"n": 3, "list": '), item, F.lit("}"))).otherwise('{"n": {"deep": [{"id": "no"}]}}')
    docs = p.select(F.lit("s").alias("space_id"), F.col("p_brand").alias("source_label"), F.lit(None).cast("string").alias("problem"), doc.alias("doc"))
    return events_of(jsondocs.read_items(docs, jsondocs.Shape(items=None, uid="id", title="name", starts="start"), TODAY, DAYS)).select("source_label", "source_uid")


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'https://x.org/1' WHEN 1 THEN 'http://Example.org:8080/b/2' WHEN 2 THEN 'http://cdn.org/3' WHEN 3 THEN 'http://Example.org:8080/a/p?q=4' WHEN 4 THEN 'http://Example.org:8080/a/rel' ELSE 'mailto:x@y.z' END AS joined,
  'http://example.org:8080' AS origin, c_custkey % 6 IN (1, 3, 4) AS same, CASE c_custkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN 'p' WHEN 4 THEN 'rel' END AS slug FROM customer""")
def url_parts(spark, sf_dir):
    """Links as seen from a page, and their origin, host and slug."""
    base = F.lit("http://Example.org:8080/a/p?x=1#f")
    link = F.get(F.array(*[F.lit(x) for x in ("https://x.org/1", "/b/2", "//cdn.org/3", "?q=4", "rel", "mailto:x@y.z")]), (F.col("c_custkey") % 6).cast("int"))
    c = read(spark, sf_dir, "customer").select("c_custkey", text.url_joined(base, link).alias("joined"))
    slug = F.when(F.col("joined").startswith("http"), text.url_slug(F.col("joined")))
    return c.select("c_custkey", "joined", text.url_origin(base).alias("origin"), text.same_host(F.col("joined"), base).alias("same"), slug.alias("slug"))


@query("""SELECT o_orderkey, CASE WHEN month(o_orderdate) BETWEEN 5 AND 9 THEN '-07:00' WHEN month(o_orderdate) IN (1, 2, 12) THEN '-08:00' END AS los_angeles, '+05:30' AS kolkata, CASE o_orderkey % 4 WHEN 0 THEN '+00:00' WHEN 1 THEN '-03:30' WHEN 2 THEN '+09:00' END AS written FROM orders WHERE month(o_orderdate) NOT IN (3, 4, 10, 11)""")
def offsets(spark, sf_dir):
    """Offsets of zones at an instant, and those that times end in."""
    o = read(spark, sf_dir, "orders").where("month(o_orderdate) not in (3, 4, 10, 11)")
    at = instant(F.col("o_orderdate"))
    form = F.get(F.array(*[F.lit(x) for x in ("2024-01-01T00:00:00Z", "2024-01-01T00:00-0330", "2024-01-01T00:00+09:00", "2024-01-01")]), (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", times.offset_text(at, F.lit("America/Los_Angeles")).alias("los_angeles"), times.offset_text(at, F.lit("Asia/Kolkata")).alias("kolkata"), times.iso_offset(form).alias("written"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_custkey WHEN 1 THEN -7 END AS whole, CASE c_custkey % 5 WHEN 0 THEN CAST(c_custkey AS DOUBLE) WHEN 1 THEN -7.0 WHEN 2 THEN 2.5 END AS decimal FROM customer""")
def permissive_numbers(spark, sf_dir):
    form = F.get(F.array(F.concat(F.lit(" "), "c_custkey"), F.lit("-7"), F.lit("2.5 "), F.lit("n/a"), F.lit(" ")), (F.col("c_custkey") % 5).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", text.permissive_number(form).alias("whole"), text.permissive_number(form, "double").alias("decimal"))


@query(f"""SELECT run_id, count(DISTINCT source_key) AS spaces_seen, count(*) AS sources, count(*) FILTER (WHERE status = 'ok') AS ran, CAST(0 AS BIGINT) AS skipped, count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(cur) AS BIGINT) AS events FROM {RECORDS} WHERE run_id IN (3, 12) GROUP BY run_id""")
def run_totals(spark, sf_dir):
    """Counts of two nights."""
    r = _records(spark, sf_dir).withColumn("space_id", F.col("source_key"))
    out = [gates.run_totals(r.where(F.col("run_id") == n)).where("sources > 0").select(F.lit(n).cast("long").alias("run_id"), "spaces_seen", "sources", "ran", "skipped", "failed", "events") for n in (3, 12)]
    return out[0].union(out[1])


@query(f"""SELECT source_key, source_key || ': ' || status || ', ' || cur || ' of ' || cur || ' events (' || coalesce('was ' || prev, 'new') || '), ' || CASE WHEN status = 'failed' THEN 'degraded [carried_forward]' ELSE CASE WHEN source_key = 'error' AND stale IS NULL THEN 'ok [no_last_modified]' ELSE 'ok' END END AS line FROM {RECORDS} WHERE run_id IN (4, 12) AND (prev IS NULL OR cur > prev * 0.5) AND cur > 0 AND coalesce(stale, 0) <= 20""")
def report_lines(spark, sf_dir):
    """A text line per source of two nights."""
    from marlstone.sinks import report

    r = _records(spark, sf_dir).where("run_id in (4, 12) and (previous_count is null or horizon_count > previous_count * 0.5) and horizon_count > 0 and coalesce(stale_days, 0) <= 20")
    return report.lines(gates.source_verdicts(r))


@query("""SELECT CAST(user_id AS VARCHAR) AS source_key, CASE WHEN o IS NULL OR outcome = 'fetched' THEN CASE WHEN outcome = 'fetched' THEN 'new' || n_id END ELSE 'old' END AS etag, CASE WHEN outcome IS NULL THEN 2 WHEN outcome = 'failed' THEN CASE WHEN o IS NULL THEN 1 ELSE 3 END ELSE 0 END AS failures
FROM (SELECT user_id, max(event_id) AS n_id, arg_max(CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'not_modified' ELSE 'fetched' END, event_id) AS outcome FROM events WHERE user_id % 3 > 0 GROUP BY user_id) n FULL JOIN (SELECT DISTINCT user_id, 1 AS o FROM events WHERE user_id % 2 = 0) s USING (user_id)""")
def http_state(spark, sf_dir):
    """Validators and failure counts after a night of answers."""
    e = read(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "not_modified").otherwise("fetched")
    none = F.lit(None).cast("string")
    answers = e.where("user_id % 3 > 0").groupBy("user_id").agg(F.max("event_id").alias("n_id"), F.max_by(outcome, "event_id").alias("outcome")).select(F.col("user_id").cast("string").alias("source_key"), "outcome", F.when(F.col("outcome") == "fetched", F.concat(F.lit("new"), "n_id")).alias("etag"), none.alias("last_modified"), none.alias("body_sha256"))
    stored = e.where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("source_key"), F.lit("old").alias("etag"), none.alias("last_modified"), none.alias("body_sha256"), F.lit(2).alias("failures")).distinct()
    return state.http_state(stored, answers).select("source_key", "etag", "failures")


@query(f"""SELECT h.source_key, count(*) AS nights, count(*) FILTER (WHERE r.dry) AS dry FROM {HISTORY} h JOIN (SELECT event_id, event_id % 4 = 0 AS dry FROM events WHERE event_id % 3 > 0) r ON h.run_id = r.event_id GROUP BY h.source_key""")
def history_of_runs(spark, sf_dir):
    """Per-source history takes dry_run from its run; nights of unknown runs are left out."""
    runs = read(spark, sf_dir, "events").where("event_id % 3 > 0").select(F.col("event_id").alias("run_id"), (F.col("event_id") % 4 == 0).alias("dry_run"), F.lit(None).cast("string").alias("space_filter"))
    return state.with_runs(_history(spark, sf_dir), runs).groupBy("source_key").agg(F.count("*").alias("nights"), F.count_if("dry_run").alias("dry"))


@query("SELECT c_mktsegment AS uid, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def repeated_uids(spark, sf_dir):
    return calendar.repeated(read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("uid")))


@query("SELECT least(count(*), 200) AS listed, greatest(count(*) - 200, 0) AS left_out FROM orders")
def feed_left_out(spark, sf_dir):
    return feed.left_out(read(spark, sf_dir, "orders"))


@query("""SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END, CASE WHEN event_id % 4 > 0 THEN ts END NULLS FIRST, CAST(event_id AS VARCHAR)) AS nth FROM events""")
def day_order(spark, sf_dir):
    """Raw events of a source by day, whole days first, then time and uid."""
    e = read(spark, sf_dir, "events")
    whole = F.col("event_id") % 4 == 0
    have = {"source_uid": F.col("event_id").cast("string"), "start_local": F.when(~whole, F.col("ts")), "start_date": F.when(whole, F.to_date("ts")), "all_day": whole}
    raws = e.select("event_id", "user_id", *[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_EVENT.fields])
    return raws.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*normalize.day_order())).cast("long").alias("nth"))


@query("""SELECT user_id, sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS kept, min(event_id) AS first_event FROM events GROUP BY user_id""")
def health_document(spark, sf_dir):
    """The health document of a run per user, read back: a block per source, in order."""
    e = read(spark, sf_dir, "events")
    verdicts = e.groupBy("user_id").agg(F.sum(F.col("event_type").isin("view", "click").cast("int")).cast("long").alias("event_count"), F.min("event_id").alias("horizon_count")).withColumn("source_key", F.col("user_id").cast("string"))
    run = spark.range(1).select(F.lit(False).alias("blocked"))
    doc = health.document(verdicts, run, F.lit(NOW)).select(F.from_json("json", "blocked boolean, sources array<struct<source_key:string,event_count:bigint,horizon_count:bigint>>").alias("d"))
    back = doc.select(F.explode("d.sources").alias("s"))
    return back.select(F.col("s.source_key").cast("long").alias("user_id"), F.col("s.event_count").alias("kept"), F.col("s.horizon_count").alias("first_event"))


# ---------------------------------------------------------------- registry, transport rules, publication


@query("""SELECT n_name AS space_id, 's' || s_suppkey AS source_label, s_suppkey % 3 > 0 AS enabled, CAST(s_suppkey % 10 AS INTEGER) AS trust, 'https://example.org/' || s_suppkey || '?page=2&key=secret' AS url, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'Europe/Paris' END, 'America/New_York') AS timezone
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def registry_sources(spark, sf_dir):
    """A registry written as YAML, read with its placeholders filled, as spaces and sources."""
    import yaml

    rows = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "n_nationkey", "s_suppkey").collect()  # a registry is a file
    spaces: dict[str, dict] = {}
    for r in sorted(rows):
        space = spaces.setdefault(r["n_name"], {"id": r["n_name"], "name": r["n_name"].title(), "sources": []} | ({"timezone": "Europe/Paris"} if r["n_nationkey"] % 2 == 0 else {}))
        space["sources"].append({"adapter": "ics", "label": f"s{r['s_suppkey']}", "url": f"https://example.org/{r['s_suppkey']}?key=old&page=2", "params": {"key": "${KEY}"}, "enabled": r["s_suppkey"] % 3 > 0, "trust": r["s_suppkey"] % 10})
    text_ = yaml.dump({"defaults": {"timezone": "America/New_York"}, "spaces": list(spaces.values())}, Dumper=getattr(yaml, "CSafeDumper", yaml.SafeDumper))
    found, sources = registry.load(text_, {"KEY": "secret"}).frames(spark)
    return sources.join(found.select("space_id", "timezone"), "space_id").select("space_id", "source_label", "enabled", "trust", "url", "timezone")


@query("""SELECT c_custkey, CASE WHEN s IN (408, 425, 429, 500, 502, 503, 504) OR s BETWEEN 520 AND 527 THEN '1.0,2.0' ELSE '' END AS waits FROM (SELECT c_custkey, 400 + c_custkey % 140 AS s FROM customer)""")
def retry_waits(spark, sf_dir):
    """Waits before further attempts where the same answer comes back each time."""
    waits = {s: ",".join(map(str, payloads.delays([s] * 5))) for s in range(400, 540)}
    known = F.create_map(*[F.lit(x) for pair in waits.items() for x in pair])
    return read(spark, sf_dir, "customer").select("c_custkey", F.try_element_at(known, (F.lit(400) + F.col("c_custkey") % 140).cast("int")).alias("waits"))


@query("""SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN CASE c_custkey % 4 WHEN 0 THEN false WHEN 1 THEN false WHEN 2 THEN true ELSE true END WHEN 1 THEN true WHEN 2 THEN false ELSE false END AS allowed FROM customer""")
def robots_verdicts(spark, sf_dir):
    """Paths by a host's robots.txt: both our agent and * must allow; 404 allows all, 503 and silence nothing."""
    text_ = "User-agent: *\nDisallow: /private\nAllow: /private/open\n\nUser-agent: marlstone\nDisallow: /no # not us\nDisallow:\n"
    hosts = [payloads.Robots.of(200, text_), payloads.Robots.of(404), payloads.Robots.of(503), payloads.Robots.of(None)]
    paths = ["/private/x", "/no/thing", "/private/open/1", "/other"]
    said = F.create_map(*[F.lit(x) for h, robots in enumerate(hosts) for p, path in enumerate(paths) for x in (h * 4 + p, robots.allows("Marlstone/1.0", path))])
    return read(spark, sf_dir, "customer").select("c_custkey", F.try_element_at(said, ((F.col("c_nationkey") % 4) * 4 + F.col("c_custkey") % 4).cast("int")).alias("allowed"))


@query("""SELECT CAST(n_regionkey AS VARCHAR) AS source_label, CASE n_regionkey % 3 WHEN 0 THEN 'http_error' WHEN 1 THEN 'some_pages_failed' END AS problem, count(*) AS pages, count(*) FILTER (WHERE n_regionkey % 3 = 0 OR (n_regionkey % 3 = 1 AND n_nationkey % 2 = 0)) AS failed FROM nation GROUP BY n_regionkey""")
def seed_verdicts(spark, sf_dir):
    """All pages of a seed list failing is a failure, some are a note."""
    bad = (F.col("n_regionkey") % 3 == 0) | ((F.col("n_regionkey") % 3 == 1) & (F.col("n_nationkey") % 2 == 0))
    pages = read(spark, sf_dir, "nation").select(F.lit("s").alias("space_id"), F.col("n_regionkey").cast("string").alias("source_label"), F.when(bad, "http_error").alias("problem"))
    return markup.seed_verdicts(pages).drop("space_id")


@query("""SELECT event_type AS source_key, CASE WHEN ts > timestamp '2024-01-25 08:00:00' THEN 'too_far' ELSE 'over' END AS reason, count(*) AS n FROM events WHERE event_type <> 'view' AND (ts > timestamp '2024-01-25 08:00:00' OR ts < timestamp '2024-01-15 08:00:00') GROUP BY ALL""")
def carry_losses(spark, sf_dir):
    """Stored events that a republication leaves out, with the reason."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("source_key"), instant(F.col("ts")).alias("start_utc"), F.lit(False).alias("all_day"), F.lit(None).cast("date").alias("end_date"), F.lit("America/Los_Angeles").alias("tz"))
    plan = e.select("source_key").distinct().withColumn("action", F.when(F.col("source_key") == "view", "none").otherwise("carry"))
    return state.carry_losses(plan, e, F.lit(NOW), 10)


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS at, CASE WHEN event_id % 3 > 0 THEN strftime(ts, '%Y-%m-%d') END AS day, props, list_value(event_type, NULL)[1] AS kind FROM events")
def wire_codec(spark, sf_dir):
    """Events to JSON texts and back."""
    from marlstone.functions import wire

    e = read(spark, sf_dir, "events").select("event_id", instant(F.col("ts")).alias("at"), F.when(F.col("event_id") % 3 > 0, F.to_date("ts")).alias("day"), "props", F.array("event_type", F.lit(None).cast("string")).alias("kinds"))
    back = wire.decoded(e.select(wire.encoded(*e.columns).alias("json")), F.col("json"), e.schema)
    return back.select("event_id", seconds("at").alias("at"), shown(F.col("day"), "yyyy-MM-dd").alias("day"), "props", F.get("kinds", F.lit(0)).alias("kind"))


def _published(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Suppliers as events of their nations, and the nations as spaces."""
    n = read(spark, sf_dir, "nation")
    s = read(spark, sf_dir, "supplier")
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    start = F.timestamp_seconds(F.lit(1704067200) + k * 3600)
    e = s.select(
        F.concat(F.lit("u"), k).alias("uid"), F.col("s_nationkey").cast("string").alias("space_id"), F.lit("l").alias("source_label"), F.concat("s_name", F.lit(", né")).alias("title"), start.alias("start_utc"), F.timestamp_seconds(F.unix_timestamp(start) + 3600).alias("end_utc"), F.lit("UTC").alias("tz"), (k % 4 == 0).alias("all_day"),
        F.when(k % 4 == 0, F.to_date(start)).alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit("1 Main St").alias("address"), F.lit("Hall").alias("location_name"), none.alias("url"), none.alias("price"), F.repeat(F.lit("long text; "), F.lit(40)).alias("description"), none.alias("summary_line"), F.array(F.lit("c")).alias("categories"),
    )
    return e, n.select(F.col("n_nationkey").cast("string").alias("space_id"), F.col("n_name").alias("name"), F.lit("https://example.org/").alias("url"))


@query("""SELECT 'events.ics' AS file, count(*) AS events FROM supplier UNION ALL SELECT s_nationkey || '.ics', count(*) FROM supplier GROUP BY s_nationkey""")
def published_calendars(spark, sf_dir):
    """Calendar files written and read back: one for all and one a space, each valid."""
    import tempfile
    from pathlib import Path

    e, spaces = _published(spark, sf_dir)
    with tempfile.TemporaryDirectory() as folder:
        paths = calendar.emit(e, spaces, folder, NOW)
        found = [(p.name, calendar.validate(p.read_bytes(), Path(p).read_text().count("BEGIN:VEVENT"))) for p in paths]
    return spark.createDataFrame(found, "file string, events long")


@query("""SELECT 'u' || s_suppkey AS guid, '[' || n_name || '] ' || s_name || ', né' AS title, row_number() OVER (ORDER BY s_suppkey % 7 DESC, 'u' || s_suppkey) AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey QUALIFY place <= 200""")
def published_feed(spark, sf_dir):
    """The feed file written and read back: newest first sight first, at most two hundred."""
    import tempfile
    from xml.etree import ElementTree

    e, spaces = _published(spark, sf_dir)
    seen = e.withColumn("seen_at", F.timestamp_seconds(F.lit(1700000000) + (F.substring("uid", 2, 9).cast("long") % 7) * 60))
    with tempfile.TemporaryDirectory() as folder:
        items = ElementTree.parse(feed.emit(seen, spaces, folder, NOW)).findall("./channel/item")
    return spark.createDataFrame([(i.findtext("guid"), i.findtext("title"), n + 1) for n, i in enumerate(items)], "guid string, title string, place long")


@query(f"""SELECT 's' AS space_id, 'o' || o_orderkey AS source_uid, md5(CAST(o_orderkey AS VARCHAR)) AS title FROM {ORDERS} WHERE o_custkey % 4 < 3 AND day BETWEEN date '1996-06-02' AND date '1996-06-16' AND o_orderkey % 5 > 0""")
def nightly_events(spark, sf_dir):
    """A night from calendars to the published set: three sources run, one is disabled, one filter drops, nothing is stored."""
    import tempfile

    from marlstone.plans import nightly

    o = read(spark, sf_dir, "orders").where("o_orderdate between timestamp_ntz'1996-06-02' and timestamp_ntz'1996-06-16'").withColumns({"space_id": F.lit("s"), "source_label": F.concat(F.lit("c"), F.col("o_custkey") % 4)})
    title = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("Private "), F.col("o_orderkey"))).otherwise(F.md5(F.col("o_orderkey").cast("string")))
    entry = F.concat_ws("\r\n", F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:o"), "o_orderkey"), F.concat(F.lit("SUMMARY:"), title), F.concat(F.lit("DTSTART:"), shown(F.col("o_orderdate"), "yyyyMMdd'T'180000'Z'")), F.lit("END:VEVENT\r\n"))
    bodies = joined(o, ["space_id", "source_label"], "o_orderkey", entry, "")
    got = landed(bodies, F.concat(F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:x\r\n"), F.col("body"), F.lit("END:VCALENDAR\r\n")), "text/calendar")
    listed = "".join(f"{{adapter: ics, label: c{i}, url: 'https://example.org/{i}', enabled: {str(i < 3).lower()}, health: {{allow_zero: true}}, filters: {{title_excludes: [PRIVATE]}}}}, " for i in range(4))
    spaces, sources = registry.load(f"spaces: [{{id: s, name: Space, url: 'https://example.org', sources: [{listed}]}}]", {}).frames(spark)
    with tempfile.TemporaryDirectory() as folder:
        night = nightly.run(spark, got, spaces, sources, dt.datetime(1996, 6, 1, 12), folder, horizon_days=20, dry_run=True)
    return night.events.select("space_id", "source_uid", "title")


@query("SELECT event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS seen FROM events WHERE event_id % 2 = 0")
def state_snapshots(spark, sf_dir):
    """State saved twice and read back: the newest snapshot is current."""
    import uuid

    from marlstone.plans import nightly
    from marlstone.staging import shared_dir

    path = f"{shared_dir(spark).removeprefix('file://')}/state-{uuid.uuid4().hex}"
    e = read(spark, sf_dir, "events").select("event_id", "event_type", instant(F.col("ts")).alias("seen"))
    rest = [spark.createDataFrame([], s) for s in (nightly.Snapshot.RUNS, nightly.Snapshot.HISTORY, nightly.Snapshot.HTTP)]
    nightly.Snapshot(e, *rest).save(path, "run-1")
    nightly.Snapshot(e.where("event_id % 2 = 0"), *rest).save(path, "run-2")
    return nightly.Snapshot.load(spark, path, e.schema).events.select("event_id", "event_type", seconds("seen").alias("seen"))
