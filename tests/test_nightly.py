import datetime as dt
import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from marlstone.plans import nightly
from marlstone.schemas import PAYLOAD
from marlstone.sinks import calendar, feed
from marlstone.sinks.calendar import InvalidArtifact
from marlstone.sinks.files import NothingToPublish, output_dir, refuse_empty, write_atomic
from marlstone.sources import registry
from marlstone.streaming.events import counts_by_window, upsert_stream

CONFIG = """
defaults: {timezone: America/Los_Angeles}
spaces:
  - {id: forge, name: Forge, url: "https://forge.example", sources: [{adapter: ics, label: cal, url: "https://forge.example/c.ics", trust: 5}, {adapter: rss, label: news, url: "https://forge.example/r", health: {allow_zero: true}}]}
  - {id: loft, name: Loft, url: "https://loft.example", sources: [{adapter: ics, label: cal, url: "https://loft.example/c.ics", filters: {title_excludes: [private]}}]}
"""


def ical(*events):
    body = "".join(f"BEGIN:VEVENT\r\nUID:{u}\r\nSUMMARY:{t}\r\nDTSTART:{s}\r\nDTEND:{e}\r\nDTSTAMP:20260301T000000Z\r\nEND:VEVENT\r\n" for u, t, s, e in events)
    return f"BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:x\r\n{body}END:VCALENDAR\r\n"


FORGE = ical(("1", "Welding, basics; day", "20260305T180000Z", "20260305T200000Z"), ("2", "Welding basics day", "20260305T181000Z", "20260305T200000Z"), ("3", "Casting", "20260309T180000Z", "20260309T200000Z"))
LOFT = ical(("9", "Private party", "20260306T180000Z", "20260306T200000Z"), ("8", "Sewing", "20260307T180000Z", "20260307T200000Z"))
RSS = '<rss version="2.0"><channel><item><guid>a</guid><title>n</title><pubDate>Sun, 01 Mar 2026 00:00:00 GMT</pubDate></item></channel></rss>'


def payloads(spark, forge=FORGE, loft=LOFT):
    day = dt.datetime(2026, 3, 1)
    row = lambda s, label, kind, body: (s, label, "https://x", 200 if body else 503, kind, {}, (body or "").encode(), "fetched" if body else "failed", day)
    return spark.createDataFrame([row("forge", "cal", "text/calendar", forge), row("forge", "news", "application/rss+xml", RSS), row("loft", "cal", "text/calendar", loft)], PAYLOAD)


def test_two_nights(spark, tmp_path):
    spaces, sources = registry.load(CONFIG, {}).frames(spark)
    go = lambda night, state=str(tmp_path / "state"), **k: nightly.run(spark, payloads(spark, **k), spaces, sources, dt.datetime(2026, 3, night, 12), tmp_path / "out", state)
    first = go(1)
    assert sorted(r.uid for r in first.events.collect()) == ["forge:1", "forge:3", "loft:8"] and not first.blocked
    text = (tmp_path / "out" / "events.ics").read_text()
    assert text.count("BEGIN:VEVENT") == 3 and "SUMMARY:[Forge] Welding\\, basics\\; day" in text and (tmp_path / "out" / "loft.ics").exists()
    items = ElementTree.parse(tmp_path / "out" / "events.rss").findall("./channel/item")
    assert len(items) == 3 and items[0].findtext("title").startswith("[")
    health = json.loads((tmp_path / "out" / "health.json").read_text())
    assert health["event_count"] == 3 and {s["source_key"]: s["outcome"] for s in health["sources"]} == {"forge:cal": "ok", "forge:news": "exempt", "loft:cal": "ok"}

    second = go(2, forge=None)  # the feed fails: its last good set is carried
    assert sorted(r.uid for r in second.events.collect()) == ["forge:1", "forge:3", "loft:8"]
    assert {r.source_key: r.outcome for r in second.verdicts.collect()}["forge:cal"] == "degraded" and not second.blocked
    stored = {r.uid: r for r in nightly.Snapshot.load(spark, str(tmp_path / "state"), None).events.collect()}
    assert stored["forge:1"].last_seen == dt.datetime(2026, 3, 1, 12) and stored["loft:8"].last_seen == dt.datetime(2026, 3, 2, 12) and stored["loft:8"].first_seen == dt.datetime(2026, 3, 1, 12)

    before = (tmp_path / "out" / "events.ics").read_bytes()
    third = go(3, loft=ical())  # a feed empties overnight: nothing is published
    assert third.blocked and third.summary.first()["blocking"] and (tmp_path / "out" / "events.ics").read_bytes() == before


def test_artifacts(spark, tmp_path):
    good = ical(("1", "a", "20260305T180000Z", "20260305T200000Z")).encode()
    assert calendar.validate(good, 1) == 1
    for bad, n in ((good, 2), (b"nope", 0), (good.replace(b"T180000Z", b"T180000"), 1), (good.replace(b"SUMMARY:a", b"RRULE:FREQ=DAILY\r\nSUMMARY:a"), 1), (good.replace(b"SUMMARY:a\r\n", b""), 1), (ical(*[("1", "a", "20260305T180000Z", "20260305T200000Z")] * 2).encode(), 2)):
        with pytest.raises(InvalidArtifact):
            calendar.validate(bad, n)
    with pytest.raises(InvalidArtifact):
        feed.validate(b"<rss><channel><item><guid>1</guid><pubDate>Sun, 01 Mar 2026 00:00:00 GMT</pubDate></item><item><guid>2</guid><pubDate>Mon, 02 Mar 2026 00:00:00 GMT</pubDate></item></channel></rss>", 2)
    with pytest.raises(NothingToPublish):
        refuse_empty(spark.range(0))
    write_atomic(tmp_path / "a" / "b.txt", b"1")
    write_atomic(tmp_path / "a" / "b.txt", b"2")
    assert [(p.name, p.read_bytes()) for p in (tmp_path / "a").iterdir()] == [("b.txt", b"2")]
    assert output_dir("out", dry_run=True).name == ".staging" and output_dir("out").name == "out"
    line = spark.range(1).select(calendar.folded(F.lit("X:" + "é" * 90))).first()[0]
    assert all(len(part.encode()) <= 75 for part in line.split("\r\n")) and line.replace("\r\n ", "") == "X:" + "é" * 90


def test_stream(spark, tmp_path):
    cols = "uid string, space_id string, start_utc timestamp, content_hash string, first_seen timestamp, last_seen timestamp"
    night = lambda d, *rows: spark.createDataFrame([(u, "s", dt.datetime(2026, 3, 5), h, None, dt.datetime(2026, 3, d)) for u, h in rows], cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(cols).parquet(str(tmp_path / "in"))
    for d, rows in ((1, [("a", "1"), ("b", "1")]), (2, [("a", "2")])):
        night(d, *rows)
        upsert_stream(source(), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination(120)
    newest = (tmp_path / "state" / "CURRENT").read_text().split()[-1]
    got = {r.uid: r for r in spark.read.parquet(str(tmp_path / "state" / newest)).collect()}
    assert got["a"].content_hash == "2" and got["a"].first_seen == dt.datetime(2026, 3, 1) and got["a"].last_changed_at == dt.datetime(2026, 3, 2) and got["b"].last_seen == dt.datetime(2026, 3, 1)
    q = counts_by_window(source()).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counts").first()["n"] == 3
