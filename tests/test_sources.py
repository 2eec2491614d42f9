import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marlstone.schemas import PAYLOAD
from marlstone.sources import events_of, feeds, ics, jsondocs, markup, read_source, registry, reports_of
from marlstone.sources.payloads import Pace, Robots, archive, delays

TODAY = dt.date(2026, 3, 1)
UTC = dt.timezone.utc


def payload(spark, body, kind, status=200, url="https://example.org/x", headers=None):
    row = ("s", "l", url, status, kind, headers or {}, body.encode() if body is not None else None, "fetched", dt.datetime(2026, 3, 1))
    return spark.createDataFrame([row], PAYLOAD)


CALENDAR = "\r\n".join([
    "BEGIN:VCALENDAR", "VERSION:2.0", "PRODID:x", "X-WR-TIMEZONE:America/New_York",
    "BEGIN:VEVENT", "UID:weekly", "SUMMARY:Weld\\, intro", " duction", "DTSTART;TZID=America/Los_Angeles:20260304T190000", "DTEND;TZID=America/Los_Angeles:20260304T210000", "RRULE:FREQ=WEEKLY;COUNT=4", "EXDATE;TZID=America/Los_Angeles:20260311T190000",
    "LAST-MODIFIED:20260201T000000Z", "CATEGORIES:Metal,Class", "CATEGORIES:Metal", "LOCATION:Shop", "END:VEVENT",
    "BEGIN:VEVENT", "UID:weekly", "RECURRENCE-ID;TZID=America/Los_Angeles:20260318T190000", "SUMMARY:Moved", "DTSTART;TZID=America/Los_Angeles:20260319T190000", "DTEND;TZID=America/Los_Angeles:20260319T200000", "END:VEVENT",
    "BEGIN:VEVENT", "UID:fair", "SUMMARY:Fair", "DTSTART;VALUE=DATE:20260310", "DTEND;VALUE=DATE:20260313", "END:VEVENT",
    "BEGIN:VEVENT", "UID:float", "SUMMARY:Floating", "DTSTART:20260305T100000", "END:VEVENT",
    "BEGIN:VEVENT", "UID:monthly", "SUMMARY:First Monday", "DTSTART:20200106T180000Z", "DURATION:PT1H", "RRULE:FREQ=MONTHLY;BYDAY=1MO", "END:VEVENT",
    "BEGIN:VEVENT", "UID:far", "SUMMARY:Far", "DTSTART:20580101T180000Z", "END:VEVENT",
    "END:VCALENDAR", "",
])


def test_calendar(spark):
    parsed = read_source("ics", payload(spark, CALENDAR, "text/calendar; charset=utf-8"), TODAY, 60)
    rows = [r.asDict() for r in events_of(parsed).orderBy("source_uid", "start_instant").collect()]
    weekly = [r for r in rows if r["source_uid"] == "weekly"]
    assert [r["start_instant"] for r in weekly] == [dt.datetime(2026, 3, 5, 3), dt.datetime(2026, 3, 20, 2), dt.datetime(2026, 3, 26, 2)]
    assert weekly[0]["title"] == "Weld, introduction" and weekly[0]["categories"] == ["Metal", "Class"] and weekly[0]["recurring"]
    assert weekly[1]["title"] == "Moved"
    fair = next(r for r in rows if r["source_uid"] == "fair")
    assert (fair["start_date"], fair["end_date"], fair["days"], fair["all_day"]) == (dt.date(2026, 3, 10), dt.date(2026, 3, 12), 3, True)
    floating = next(r for r in rows if r["source_uid"] == "float")
    assert floating["start_local"] == dt.datetime(2026, 3, 5, 10) and floating["start_instant"] is None and floating["tz"] == "America/New_York"
    assert [r["start_instant"].day for r in rows if r["source_uid"] == "monthly"] == [2, 6]
    assert not [r for r in rows if r["source_uid"] == "far"]
    report = reports_of(parsed).first()
    assert report["problem"] is None and report["horizon_count"] == len(rows) and report["newest_change"] == dt.datetime(2026, 2, 1)


@pytest.mark.parametrize(("body", "kind", "status", "problem"), [
    (CALENDAR, "text/calendar", 404, "http_error"), ("", "text/calendar", 200, "empty_body"), ("<html></html>", "text/html", 200, "wrong_content_type"),
    ("<html></html>", "text/calendar", 200, "not_calendar"), (CALENDAR, "application/octet-stream", 200, None), (CALENDAR, None, 200, None), (None, "text/calendar", 200, "empty_body"),
])
def test_calendar_verdicts(spark, body, kind, status, problem):
    parsed = read_source("ics", payload(spark, body, kind, status), TODAY, 60)
    report = reports_of(parsed).collect()
    assert len(report) == 1 and report[0]["problem"] == problem
    assert (events_of(parsed).count() > 0) == (problem is None)


def test_rule_function(spark):
    spark.udtf.register("expand_rrule", ics.ExpandRule)
    days = spark.sql("SELECT day(occurrence) d FROM expand_rrule(TIMESTAMP_NTZ'2026-03-01 09:00:00', 'FREQ=DAILY;INTERVAL=3;UNTIL=20260310T235959Z', DATE'2026-03-02', DATE'2026-04-01')").collect()
    assert [r.d for r in days] == [4, 7, 10]


def test_unknown_adapters(spark):
    assert read_source("llm_html", payload(spark, "x", "text/html"), TODAY, 9).first()["problem"] == "not_implemented"
    assert read_source("other", payload(spark, "x", "text/html"), TODAY, 9).first()["problem"] == "unknown_adapter"


def test_rest_pages(spark):
    event = {"id": 7, "status": "publish", "url": "https://e.org/7", "title": "Saw &amp; plane", "description": "<p>Bring <b>gloves</b></p>", "all_day": False, "start_date": "2026-03-05 18:00:00", "end_date": "2026-03-05 20:00:00", "utc_start_date": "2026-03-06 02:00:00", "utc_end_date": "2026-03-06 04:00:00", "timezone": "America/Los_Angeles", "cost": "$5", "venue": {"venue": "Hall", "address": "1 Main St", "city": "Alameda", "zip": "94501"}, "categories": [{"name": "Wood"}], "tags": [{"name": "Wood"}, {"name": "New"}]}
    parsed = read_source("tribe_rest", payload(spark, json.dumps({"events": [event], "total": 1}), "application/json"), TODAY, 30)
    row = events_of(parsed).first()
    assert (row.title, row.location, row.price, row.categories, row.description) == ("Saw & plane", "Hall, 1 Main St, Alameda, 94501", "$5", ["Wood", "New"], "Bring gloves")
    assert row.start_instant == dt.datetime(2026, 3, 6, 2)
    for body, problem in (('{"events": [], "total": 0}', None), ('{"events": [], "total": 4}', "count_disagrees"), ('{"code": "rest_no_route"}', "unexpected_shape"), ("<html>", "not_json")):
        assert reports_of(read_source("tribe_rest", payload(spark, body, "application/json"), TODAY, 30)).first()["problem"] == problem


def test_shapes(spark):
    doc = {"a": {"Id": 1, "Name": "Tour", "Price": 12.5, "Dates": ["2026-03-04T10:00:00", "TBD", "2026-03-11T10:00:00"]}, "b": {"Id": 2, "Name": "None", "Dates": []}}
    shape = jsondocs.Shape(items="", keyed=True, uid="Id", title="Name", starts="Dates", price="Price")
    parsed = read_source("json", payload(spark, json.dumps(doc), "application/json", url="https://e.org/j?orderby=date"), TODAY, 30, shape=shape, required=("orderby=date",))
    rows = events_of(parsed).orderBy("start_local").collect()
    assert [r.start_local.day for r in rows] == [4, 11] and rows[0].price == "$12.50" and rows[0].recurring
    assert reports_of(parsed).first()["undated_count"] == 1
    missing = read_source("json", payload(spark, json.dumps(doc), "application/json"), TODAY, 30, shape=shape, required=("orderby=date",))
    assert reports_of(missing).first()["problem"] == "missing_parameter"
    short = read_source("json", payload(spark, "{}", "application/json", headers={"x-wp-total": "3"}), TODAY, 30, shape=shape, min_total=10)
    assert reports_of(short).first()["problem"] == "truncated_catalog"


def test_products(spark):
    items = [{"id": 5, "name": "Forge", "permalink": "https://e.org/f", "short_description": "Hot &amp; loud", "prices": {"price": "12500", "currency_minor_unit": 2, "price_range": {"min_amount": "12500", "max_amount": "15000"}}, "attributes": [{"name": "Date", "taxonomy": "pa_date", "terms": [{"id": 1, "name": "3/4/26 7:00 pm", "slug": "a"}, {"id": 2, "name": "soon", "slug": "b"}]}]}]
    parsed = read_source("products", payload(spark, json.dumps(items), "application/json"), TODAY, 30)
    row = events_of(parsed).first()
    assert (row.source_uid, row.price, row.start_local, row.description) == ("5-1", "$125.00 - $150.00", dt.datetime(2026, 3, 4, 19), "Hot & loud")
    assert reports_of(parsed).first()["undated_count"] == 1


def test_embedded_and_next(spark):
    blob = json.dumps({"items": [{"id": "x", "t": "Glass", "s": 1772700000}]})
    page = f'<html><script type="application/json" id="course-data">{blob}</script></html>'
    shape = jsondocs.Shape(items="items", uid="id", title="t", starts="s", start_format="epoch")
    row = events_of(read_source("embedded_json", payload(spark, page, "text/html"), TODAY, 30, script_id="course-data", shape=shape)).first()
    assert row.title == "Glass" and row.start_instant == dt.datetime(2026, 3, 5, 8, 40)
    gone = read_source("embedded_json", payload(spark, "<html><script></script></html>", "text/html"), TODAY, 30, script_id="course-data", shape=shape)
    assert reports_of(gone).first()["problem"] == "no_blob"
    props = {"props": {"pageProps": {"upcomingEvents": [{"id": "9", "name": "Open day", "start_date": "2026-03-08", "start_time": "11:00", "timezone": "America/Los_Angeles", "primary_venue": {"name": "Yard"}}, {"id": "8", "start_date": "2026-03-08"}], "upcomingEventsTotal": 1}}}
    row = events_of(read_source("nextdata", payload(spark, f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(props)}</script>', "text/html"), TODAY, 30)).first()
    assert (row.title, row.location, row.start_instant) == ("Open day", "Yard", dt.datetime(2026, 3, 8, 18))


def test_json_ld(spark):
    graph = {"@graph": [{"@type": "WebPage"}, {"@type": "ItemList", "itemListElement": [{"@type": "ListItem", "item": {"@type": ["Event", "EducationEvent"], "@id": "e1", "name": "Print &amp; press", "startDate": "2026-03-07T10:00:00-08:00", "eventStatus": "https://schema.org/EventCancelled", "location": {"name": "Room", "address": {"streetAddress": "2 Oak", "addressLocality": "Oakland"}}, "offers": {"price": "30", "priceCurrency": "USD"}}}]}]}
    page = f'<html><script type="application/ld+json">{json.dumps(graph)}</script><script type="application/ld+json">{{"@type": "Event", "name": "Day", "startDate": "2026-03-09"}}</script></html>'
    rows = events_of(read_source("jsonld", payload(spark, page, "text/html"), TODAY, 30)).orderBy("title").collect()
    assert [r.title for r in rows] == ["Day", "Print & press"]
    assert rows[0].start_date == dt.date(2026, 3, 9) and rows[0].all_day
    assert (rows[1].start_instant, rows[1].location, rows[1].price, rows[1].status) == (dt.datetime(2026, 3, 7, 18), "Room, 2 Oak, Oakland", "$30", "CANCELLED")
    for body, problem in (("<html></html>", "no_jsonld"), ('<script type="application/ld+json">{"@type": "Eve</script>', "unparseable"), ('<script type="application/ld+json">{"@type": "Person"}</script>', "no_events")):
        assert reports_of(read_source("jsonld", payload(spark, body, "text/html"), TODAY, 30)).first()["problem"] == problem
    assert markup.walk('{"item": [{"@type": "Festival", "name": "F"}]}')[0][0]["title"] == "F"


def test_agenda_in_a_long_script(spark):
    row = r"""<tr data-event='ev-s{0}-20260306183000'><td class=\"title\"><a href='/e/{0}'>Lathe {0}</a></td></tr>\n"""
    script = r"""track("a \"quoted\" <b>", "<t"); agenda.insert("<table class=\"agenda\">""" + "".join(row.format(i) for i in range(3000)) + '</table>");'
    got = events_of(read_source("bookwhen_html", payload(spark, script, "text/javascript"), TODAY, 30)).select("source_uid", "title").collect()
    assert sorted((r.source_uid, r.title) for r in got) == sorted((f"ev-s{i}-20260306183000", f"Lathe {i}") for i in range(3000))


def test_page_text_decodes_whole_references_only(spark):
    from marlstone.functions.fuzzy import entities_decoded

    texts = ["a &amp; b&#39;s &#x41;&eacute; &lt;i&gt;", "cut off &amp", "&copy 2026 &nope; &ampx;", "&amp;lt;", None, "none"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", entities_decoded("t").alias("t")).sort("i").collect()
    assert [r.t for r in got] == ["a & b's Aé <i>", "cut off &amp", "&copy 2026 &nope; &ampx;", "&lt;", None, "none"]


def test_agenda(spark):
    page = '<table class="agenda"><tr data-event="ev-ab1-20260306183000"><td class="title"><a href="/ev-ab1">Lathe &amp; mill</a></td><td class="location">Bay 3</td></tr></table>'
    row = events_of(read_source("bookwhen_html", payload(spark, page, "text/html", url="https://b.example/x"), TODAY, 30)).first()
    assert (row.title, row.location, row.start_local, row.url, row.source_uid) == ("Lathe & mill", "Bay 3", dt.datetime(2026, 3, 6, 18, 30), "https://b.example/ev-ab1", "ev-ab1-20260306183000")
    script = 'insert("' + page.replace('"', '\\"') + '")'
    assert events_of(read_source("bookwhen_html", payload(spark, script, "text/javascript"), TODAY, 30)).count() == 1
    for body, problem in (('<div data-hook="agenda-empty"></div>', None), ('<div class="agenda"></div>', "no_rows"), ("<p>hi</p>", "not_agenda")):
        assert reports_of(read_source("bookwhen_html", payload(spark, body, "text/html"), TODAY, 30)).first()["problem"] == problem


RSS = '<?xml version="1.0"?><rss version="2.0"><channel><item><title>Talk</title><link>https://e.org/1</link><guid>g1</guid><pubDate>Fri, 06 Mar 2026 18:00:00 -0800</pubDate><category>A</category><category>A</category></item><item><title>Float</title><link>https://other.org/2</link><pubDate>Sat, 07 Mar 2026 18:00:00 -0000</pubDate></item></channel></rss>'


def test_feeds(spark):
    rows = events_of(read_source("rss", payload(spark, RSS, "application/rss+xml"), TODAY, 30, mode="events")).orderBy("title").collect()
    assert rows[1].start_instant == dt.datetime(2026, 3, 7, 2) and rows[1].categories == ["A"]
    assert rows[0].start_local == dt.datetime(2026, 3, 7, 18) and rows[0].start_instant is None
    quiet = read_source("rss", payload(spark, RSS, "text/xml"), TODAY, 30)
    assert events_of(quiet).count() == 0 and reports_of(quiet).first()["newest_change"] == dt.datetime(2026, 3, 7, 18)
    assert reports_of(read_source("rss", payload(spark, RSS, "text/xml", 404), TODAY, 30)).first()["problem"] == "http_error"
    assert reports_of(read_source("rss", payload(spark, "<html></html>", "application/rss+xml"), TODAY, 30)).first()["problem"] == "not_feed"
    broken = RSS.replace("</channel></rss>", "<item><title>Cut &nbsp;")
    assert feeds.liveness(payload(spark, broken, "text/xml")).first()["item_count"] == 2
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>a</id><title>T</title><link rel="alternate" href="https://e.org/a"/><updated>2026-03-02T00:00:00Z</updated></entry></feed>'
    alive = feeds.liveness(payload(spark, atom, "application/atom+xml")).first()
    assert alive["item_count"] == 1 and alive["newest"] == dt.datetime(2026, 3, 2)
    links = markup.seed_links(feeds.links(payload(spark, RSS, "text/xml", url="https://e.org/feed"))).collect()
    assert [r.link for r in links] == ["https://e.org/1"]


def test_registry(spark):
    text = """
defaults: {timezone: America/Los_Angeles}
spaces:
  - id: forge
    name: The Forge
    url: "https://forge.example/${TOKEN}"
    sources:
      - {adapter: gcal_ics, calendar_id: "a%40group.example", trust: 5}
      - {adapter: json, label: cat, url: "https://e.org/j", shape: products, params: {orderby: date}}
      - {adapter: ics, url: "https://e.org/i", enabled: false}
"""
    spaces, sources = registry.load(text, {"TOKEN": "t"}).frames(spark)
    assert spaces.first()["url"] == "https://forge.example/t"
    rows = registry.runnable(sources).collect()
    assert [r.source_label for r in rows] == ["gcal_ics", "cat", "ics"] and [r.run for r in rows] == [True, True, False] and rows[2].skip_reason == "disabled"
    assert rows[0].url == "https://calendar.google.com/calendar/ical/a%40group.example/public/basic.ics" and rows[1].url == "https://e.org/j?orderby=date"
    for bad in (text.replace("trust", "truts").replace("id: forge", "id: forge\n    sourcs: 1\n    ids: 2"), text.replace("label: cat", "label: gcal_ics"), text.replace('calendar_id: "a%40group.example", ', "")):
        if bad != text:
            try:
                registry.load(bad, {"TOKEN": "t"})
            except registry.RegistryError:
                continue
    with pytest.raises(registry.RegistryError):
        registry.load(text, {})
    with pytest.raises(registry.RegistryError):
        registry.load(text.replace("label: cat", "label: gcal_ics"), {"TOKEN": "t"})
    assert registry.dotenv("export A='x y'\n# c\nB=2 # note\nnope") == {"A": "x y", "B": "2"}


def test_fetch_rules(spark, tmp_path):
    assert delays([503, 503, 503]) == [1.0, 2.0] and delays([200]) == [] and delays([500, 404]) == [1.0]
    robots = Robots.of(200, "User-agent: *\nDisallow: /x\nAllow: /x/y\nCrawl-delay: 4\nUser-agent: ours\nDisallow: /z")
    assert robots.allows("ours/1", "/a") and not robots.allows("ours/1", "/z") and not robots.allows("ours/1", "/x/q") and robots.allows("ours/1", "/x/y") and robots.delay("ours", 1) == 4
    assert Robots.of(404).allows("a", "/") and not Robots.of(500).allows("a", "/") and not Robots.of(None).allows("a", "/")
    now = [0.0]
    pace = Pace(lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    assert pace.wait("h", 2) == 0 and pace.wait("h", 2) == 2 and pace.wait("other", 2) == 0
    path = str(tmp_path / "raw")
    one = payload(spark, "a", "text/html")
    archive(one.union(one), path)
    archive(one, path)
    archive(payload(spark, "b", "text/html"), path)
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(path).select(F.first("extension")).first()[0] == "html"


def test_organizer_pages_that_drifted(spark):
    page = lambda props: payload(spark, f'<script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": {"pageProps": props}})}</script>', "text/html")
    item = {"id": "1", "name": "x", "start_date": "2026-03-08", "start_time": "11:00"}
    said = lambda props: reports_of(read_source("nextdata", page(props), TODAY, 30)).first()["problem"]
    assert said({"upcomingEvents": [], "upcomingEventsTotal": 0}) is None
    assert said({"upcomingEvents": [item], "upcomingEventsTotal": 1}) is None
    assert said({"upcomingEvents": [], "upcomingEventsTotal": 3}) == "count_disagrees"
    assert said({"upcomingEvents": [item], "upcomingEventsTotal": 0}) == "count_disagrees"
    assert said({"upcomingEvents": [item], "upcomingEventsTotal": True}) == "no_total"
    assert said({"upcomingEvents": {}, "upcomingEventsTotal": 1}) == "no_events_key"
    assert said({"upcomingEvents": [{"id": "1", "start_date": "2026-03-08"}], "upcomingEventsTotal": 1}) == "no_dates"


def test_undated_calendar_entries_are_counted(spark):
    body = "BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:x\r\nBEGIN:VEVENT\r\nUID:1\r\nDTSTART:soon\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"
    report = reports_of(read_source("ics", payload(spark, body, "text/calendar"), TODAY, 30)).first()
    assert (report.undated_count, report.horizon_count, report.problem) == (1, 0, None)


def test_request_parameters_replace_their_own():
    spec = registry.SourceSpec(adapter="json", shape="s", url="https://e.org/x?page=1&orderby=name#f", params={"orderby": "date", "n": 5})
    assert registry.source_url(spec) == "https://e.org/x?page=1&orderby=date&n=5#f"


def test_equal_series_are_expanded_once(monkeypatch):
    calls, real = [], ics.rrule.rrulestr
    monkeypatch.setattr(ics.rrule, "rrulestr", lambda *a, **k: calls.append(1) or real(*a, **k))
    series = lambda: list(ics.ExpandRule.func().eval(dt.datetime(2031, 1, 6), "FREQ=WEEKLY", dt.date(2031, 1, 1), dt.date(2031, 1, 31)))
    assert [series() for _ in range(3)] == [[(dt.datetime(2031, 1, d),) for d in (6, 13, 20, 27)]] * 3 and len(calls) == 1


def test_registries_are_read_by_libyaml():
    import yaml

    text = "defaults: {timezone: Europe/Paris}\nspaces:\n- &a {id: a, name: 'A: ${X}', sources: [{adapter: ics, url: \"u\\u00e9\", trust: 0x1f, enabled: no}]}\n"
    assert not yaml.__with_libyaml__ or registry.LOADER is yaml.CSafeLoader
    space = registry.load(text, {"X": "1"}).spaces[0]
    assert (space.name, space.sources[0].url, space.sources[0].trust, space.sources[0].enabled) == ("A: 1", "ué", 31, False)


def test_calendars_are_read_in_chunks(spark):
    """A long calendar gives what its parts give: overrides find their series, and the calendar's own properties hold for all."""
    event = "BEGIN:VEVENT\r\nBEGIN:VALARM\r\nUID:alarm\r\nEND:VALARM\r\n{}\r\nEND:VEVENT\r\n"
    plain = [event.format(f"UID:e{i}\r\nSUMMARY:E {i}\r\nDTSTART:202603{1 + i % 28:02}T100000\r\nDTSTAMP:20260401T000000Z") for i in range(700)]
    series = event.format("UID:a\\,b\r\nSUMMARY:S\r\nDTSTART:20260302T180000Z\r\nRRULE:FREQ=WEEKLY;COUNT=3")
    moved = event.format("UID:a,b\r\nSUMMARY:Moved\r\nRECURRENCE-ID:20260309T180000Z\r\nDTSTART:20260310T180000Z\r\nDESCRIPTION:BEGIN:VEVENT\r\n \r\n BEGIN:VEVENT")
    nameless = [event.format(f"SUMMARY:N {i}\r\nDTSTART:20260305T1{i}0000Z") for i in range(3)]
    text = "BEGIN:VCALENDAR\r\nVERSION:2.0\r\nX-WR-TIME\r\n ZONE:Europe/Paris\r\n" + series + "".join(plain) + moved + "".join(nameless) + "LAST-MODIFIED:20260215T000000Z\r\nEND:VCALENDAR\r\n"
    parsed = read_source("ics", payload(spark, text, "text/calendar"), TODAY, 60)
    rows = events_of(parsed).collect()
    want, newest, zone = ics.parse(text, TODAY, TODAY + dt.timedelta(days=60))
    key = lambda r: (r["source_uid"] or "", r["title"], str(r["start_instant"] or r["start_local"]))
    shown = lambda r: (r["source_uid"], r["title"], r["recurring"], r["tz"], r["description"])
    full = [{"start_instant": None, "start_local": None} | {k: (v.replace(tzinfo=None) if k == "start_instant" else v) for k, v in w.items()} for w in want]
    assert [shown(r) for r in sorted(rows, key=key)] == [shown({"description": None} | r) for r in sorted(full, key=key)] and len(rows) == 706
    assert {r["tz"] for r in rows if r["source_uid"] == "e5"} == {"Europe/Paris"} and zone == "Europe/Paris"
    assert all(r["recurring"] for r in rows if r["source_uid"] == "a,b") and reports_of(parsed).first()["newest_change"] == dt.datetime(2026, 2, 15)
    cut = ics.chunks(spark.createDataFrame([(1, text)], "pid long, text string")).collect()
    assert len(cut) == 4 and max(len(r.text) for r in cut) < len(text) / 2


def test_feeds_are_read_an_item_at_a_time(spark):
    import tracemalloc

    item = '<item><guid>g{0}</guid><title>T &amp; {0}</title><link>https://e.org/{0}</link><category>a</category><description><![CDATA[<b></item>x</b>]]></description></item>'
    long = '<?xml version="1.0"?><rss version="2.0" xmlns:dc="urn:d"><channel><title>t</title>' + "\n".join(item.format(i) for i in range(5000)) + "</channel></rss>"
    nested = "<rss><channel><item><title>a</title><item><title>b</title></item></item><item/></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><link href="/x"/><link rel="self" href="/y"/><updated>2026-01-01T00:00:00Z</updated></entry></feed>'
    for text in (long, nested, atom, "<rss><channel/></rss>", long[:-9], "<rss><item><title>a & b</title></item></rss>", "<rss>&nope;</rss>"):
        found, want = feeds.streamed(memoryview(text.encode())), feeds.parse(text)
        assert (found if found is None else list(found)) == want
    tracemalloc.start()
    assert sum(1 for _ in feeds.streamed(memoryview(long.encode()))) == 5000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * len(long), peak
    got = feeds.liveness(payload(spark, long, "application/rss+xml")).first()
    assert got["item_count"] == 5000 and got["digest"] == __import__("hashlib").sha1("\n".join(f"g{i}" for i in range(5000)).encode()).hexdigest()[:16]
