import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions import fuzzy, identity, register, text, times
from marlstone.operators import gates, normalize, resolve, rules, state
from marlstone.schemas import RAW_EVENT, SOURCES, SPACES

NOW = dt.datetime(2026, 3, 1, 12)
EVENT = "uid string, space_id string, source_label string, title string, start_utc timestamp, end_utc timestamp, location_name string, address string, url string, price string, description string, categories array<string>, summary_line string, rrule string, first_seen timestamp, last_seen timestamp, content_hash string, off_site boolean"


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_text_functions(spark):
    row = one(
        spark, text.normalize_title(F.lit("  Café-Night: «Été»_2 ")), text.clean(F.lit("  \t")), text.is_bare_url(F.lit(" WWW.x.org/a ")), text.is_bare_url(F.lit("www.x.org a")),
        text.truncated(F.lit("a" * 295 + " bbbb cccc"), 300), text.truncated(F.lit("x" * 310), 300), text.strip_tags(F.lit("<p>a</p>  <b>b</b>")), text.money(F.lit(1234.5)), text.money(F.lit(0.0)), text.url_host(F.lit("https://EXAMPLE.org:80/x")),
        text.permissive_bool(F.lit(" YES ")), text.content_type_matches(F.lit("application/ld+json"), F.lit("application/json")), text.location_state(F.lit(None).cast("string")), text.ordered_distinct(F.array(F.lit(" b"), F.lit("a"), F.lit("b"), F.lit(" "))),
    )
    assert list(row) == ["café night été 2", None, True, False, "a" * 295 + " bbbb…", "x" * 300 + "…", "a b", "$1,234.50", "Free", "example.org", True, True, "empty", ["b", "a"]]


def test_times(spark):
    la = F.lit("America/Los_Angeles")
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    row = one(spark, times.to_utc(ntz("2026-03-08 02:30:00"), la), times.to_utc(ntz("2026-11-01 01:30:00"), la), times.us_short(F.lit("3/4/26 7:05 pm")), times.us_short(F.lit("1/1/70 1:00 am")), times.epoch_instant(F.lit(1)), times.event_date_text(F.lit(dt.datetime(2026, 3, 7, 3, 30)), la))
    assert list(row) == [dt.datetime(2026, 3, 8, 10, 30), dt.datetime(2026, 11, 1, 8, 30), dt.datetime(2026, 3, 4, 19, 5), None, None, "Friday, March 6, 2026, 7:30 PM"]
    dates = [r[0] for r in spark.createDataFrame([("Fri, 06 Mar 2026 18:00:00 PST",), ("6 Mar 2026 18:00 +0100",), ("2026-03-06T18:00:00Z",), ("2026-03-06T18:00:00.123+02:00",), ("soon",)], "c string").select(times.feed_date(F.col("c"))).collect()]
    assert dates == [dt.datetime(2026, 3, 7, 2), dt.datetime(2026, 3, 6, 17), dt.datetime(2026, 3, 6, 18), dt.datetime(2026, 3, 6, 16, 0, 0, 123000), None]


def test_uid(spark):
    at = F.lit(dt.datetime(2026, 3, 4, 19))
    uid = lambda u, r: identity.make_uid(F.lit("s"), F.lit(u).cast("string"), at, F.lit("A B"), F.lit(r))
    import hashlib

    assert list(one(spark, uid("x", False), uid("x", True), uid(" ", False))) == ["s:x", "s:x:20260304T190000Z", hashlib.sha1(b"s20260304T190000Za b").hexdigest()[:16]]
    days = spark.range(17).select(identity.make_uid(F.lit("s"), F.lit("x"), F.timestamp_seconds(F.col("id") * 86400), F.lit(""), F.lit(True)).alias("u"))
    assert days.distinct().count() == 17


def test_scores(spark):
    assert fuzzy.title_score("Intro to Welding", "Introduction to welding!") == pytest.approx(82.05, abs=0.01)
    assert fuzzy.title_score("a b", "b a c") == 100 and fuzzy.title_score("", "x") == 0 and fuzzy.title_score(None, "x") == 0
    assert fuzzy.address_score("12 Main Street, Oakland", "12 main st oakland") == 100
    assert fuzzy.address_score("12 Main St", "14 Main St") == 0 and fuzzy.address_score("Oakland", "Oakland") == 0 and fuzzy.address_score("Hall 3 x", "Hall 4 x") == 0
    assert fuzzy.set_ratio("abc", "abc") == 100 and fuzzy.set_ratio("", "") == 0
    assert set(register(spark)) >= {"title_similarity", "expand_rrule", "jsonld_events", "nfkc"}
    assert spark.sql("SELECT title_similarity('a b', 'b a'), html_unescape('a &amp; b'), nfkc('ﬁ')").first()[:3] == (100.0, "a & b", "fi")


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_scores_are_symmetric(a, b):
    assert fuzzy.set_ratio(a, b) == pytest.approx(fuzzy.set_ratio(b, a)) and 0 <= fuzzy.set_ratio(a, b) <= 100


@given(st.text("abcd", max_size=9), st.text("abcd", max_size=9))
def test_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    assert fuzzy.common_subsequence(a, b) == row[-1]


def raws(spark, *rows):
    full = [tuple(r.get(f.name) for f in RAW_EVENT.fields) for r in ({"space_id": "s", "source_label": "l", "title": "T"} | x for x in rows)]
    return spark.createDataFrame(full, RAW_EVENT)


def space(spark, override=None):
    return spark.createDataFrame([("s", "Space", "https://s.example", "America/Los_Angeles", override, 0, None)], SPACES)


def test_normalize(spark):
    rows = raws(
        spark, {"source_uid": "aware", "start_instant": dt.datetime(2026, 3, 5, 3), "tz": "UTC"}, {"source_uid": "floating", "start_local": dt.datetime(2026, 3, 5, 19), "dtstart_form": "floating"},
        {"source_uid": "day", "start_date": dt.date(2026, 3, 1), "end_date": dt.date(2026, 3, 1), "all_day": True}, {"source_uid": "over", "start_date": dt.date(2026, 2, 27), "end_date": dt.date(2026, 2, 28), "all_day": True},
        {"source_uid": "past", "start_instant": dt.datetime(2026, 3, 1, 7, 59)}, {"source_uid": "today", "start_instant": dt.datetime(2026, 3, 1, 8)}, {"source_uid": "far", "start_instant": dt.datetime(2029, 1, 1)}, {"source_uid": "untitled", "title": " ", "start_instant": dt.datetime(2026, 3, 5)},
        {"source_uid": "long", "title": "x" * 201, "start_instant": dt.datetime(2026, 3, 5)}, {"source_uid": "odd", "start_local": dt.datetime(2026, 3, 5, 19), "source_tz": "UTC", "dtstart_form": "utc"}, {"source_uid": "none"},
    )
    got = {r.source_uid: r for r in normalize.normalize(rows, space(spark), F.lit(NOW)).collect()}
    assert {k: (v.disposition, v.reason) for k, v in got.items()} == {
        "aware": ("event", None), "floating": ("event", None), "day": ("event", None), "over": ("dropped", "past"), "past": ("dropped", "past"), "today": ("event", None), "far": ("dropped", "too_far"),
        "untitled": ("quarantined", "empty_title"), "long": ("quarantined", "title_too_long"), "odd": ("error", "floating_time_with_zone"), "none": ("dropped", "no_start"),
    }
    assert got["floating"].start_utc == dt.datetime(2026, 3, 6, 3) and got["floating"].tz_assumed and not got["aware"].tz_assumed
    assert (got["day"].start_utc, got["day"].end_utc) == (dt.datetime(2026, 3, 1, 8), dt.datetime(2026, 3, 2, 8))
    with pytest.raises(Exception, match="unknown space"):
        normalize.normalize(raws(spark, {"space_id": "other", "start_instant": NOW}), space(spark), F.lit(NOW)).collect()


def test_venues(spark):
    rows = raws(spark, *[{"source_uid": str(i), "location": loc, "start_instant": dt.datetime(2026, 3, 5)} for i, loc in enumerate(["House", "house!", "HOUSE", "Park", None, "https://zoom.example/x", "At Space yard"])])
    got = {r.source_uid: (r.address, r.address_source, r.off_site) for r in normalize.normalize(rows, space(spark, "1 Main St"), F.lit(NOW)).collect()}
    home = ("1 Main St", "override", False)
    assert got == {"0": home, "1": home, "2": home, "3": ("Park", "source", True), "4": home, "5": home, "6": home}
    plain = {r.source_uid: (r.address, r.address_source) for r in normalize.normalize(rows, space(spark), F.lit(NOW)).collect()}
    assert plain["3"] == ("Park", "source") and plain["5"] == (None, "none")


def sources(spark, **filters):
    lists = {k: filters.get(k, []) for k in rules.RULES} | {"location_allow_when_missing": filters.get("allow", True)}
    row = {"space_id": "s", "source_label": "l", "filters": lists, "trust": filters.get("trust", 0)}
    return spark.createDataFrame([tuple(row.get(f.name) for f in SOURCES.fields)], SOURCES)


def test_filters(spark):
    events = spark.createDataFrame([("a", "Tom &amp; Jerry", "Hall", ["Kids"]), ("b", "Open Weld", "Hall", []), ("c", "Open Weld", None, []), ("d", "Open Weld", "Yard", ["ADULT"]), ("e", "Closed private", "Hall", ["adult"]), ("f", "Other", "Hall", [])], "uid string, title string, location_name string, categories array<string>").withColumns({"space_id": F.lit("s"), "source_label": F.lit("l")})
    conf = sources(spark, title_excludes=["private", "TOM & jerry"], location_excludes=["yard"], categories_exclude=["adult"], title_contains=["open"], location_contains=["hall", "dead"])
    judged = rules.apply_filters(events, conf)
    got = {r.uid: (r.rule, r.pattern, r.kept_on_missing_location) for r in judged.collect()}
    assert got == {"a": ("title_excludes", "TOM & jerry", False), "b": (None, None, False), "c": (None, None, True), "d": ("location_excludes", "yard", False), "e": ("title_excludes", "private", False), "f": ("title_contains", None, False)}
    drops = {r.rule: r.drops for r in rules.drop_tallies(judged, conf).collect()}
    assert drops == {"title_excludes": 2, "location_excludes": 1, "categories_exclude": 0, "title_contains": 1, "location_contains": 0, "location_missing": 0}
    hits = {(r.rule, r.pattern): r.hits for r in rules.pattern_tallies(judged, conf).collect()}
    assert hits[("title_contains", "open")] == 2 and hits[("location_contains", "dead")] == 0 and hits[("location_contains", "hall")] == 1
    strict = rules.apply_filters(events, sources(spark, location_contains=["hall"], allow=False))
    assert {r.uid for r in strict.where("rule = 'location_missing'").collect()} == {"c"}
    none = rules.apply_filters(events, sources(spark))
    assert none.where("rule is not null").count() == 0


def events(spark, *rows):
    base = {"space_id": "s", "source_label": "l", "title": "Open Shop", "categories": [], "off_site": False, "content_hash": "h"}
    names = [c.split()[0] for c in EVENT.split(", ")]
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], EVENT)


def at(minutes):
    return dt.datetime(2026, 3, 5, 18) + dt.timedelta(minutes=minutes)


def test_dedupe_windows(spark):
    conf = sources(spark)
    uids = lambda *rows: sorted(r.uid for r in resolve.dedupe(events(spark, *rows), conf).collect())
    assert uids({"uid": "a", "start_utc": at(0)}, {"uid": "b", "start_utc": at(10)}) == ["a"]
    assert uids({"uid": "a", "start_utc": at(0)}, {"uid": "b", "start_utc": at(45)}) == ["a", "b"]
    assert uids({"uid": "a", "start_utc": at(0)}, {"uid": "b", "start_utc": at(30)}) == ["a"]
    assert uids({"uid": "a", "start_utc": at(0)}, {"uid": "b", "start_utc": at(29)}, {"uid": "c", "start_utc": at(58)}) == ["a", "c"]
    assert uids({"uid": "a", "start_utc": at(0)}, {"uid": "b", "start_utc": at(0), "title": "Pottery"}) == ["a", "b"]
    crowd = resolve.dedupe(events(spark, *[{"uid": f"u{i:03}", "start_utc": at(0)} for i in range(200)]), conf).collect()
    assert len(crowd) == 1 and len(crowd[0].absorbed_within) == 199


def test_dedupe_across_spaces_and_fields(spark):
    conf = sources(spark, trust=9)
    here, there = {"uid": "a", "start_utc": at(0), "address": "12 Main Street Oakland"}, {"uid": "b", "space_id": "t", "start_utc": at(5), "address": "12 main st oakland", "url": "https://x", "first_seen": at(-99), "last_seen": at(3)}
    row = resolve.dedupe(events(spark, here, there), conf).collect()
    assert len(row) == 1 and row[0].uid == "a" and row[0].url == "https://x" and row[0].first_seen == at(-99) and row[0].content_hash != "h"
    assert row[0].absorbed_across[0].uid == "b" and row[0].absorbed_across[0].filled == ["url"]
    assert resolve.dedupe(events(spark, here, there | {"address": "14 Main St Oakland"}), conf).count() == 2
    owner = [("s", "k", ["price"])]
    both = [{"uid": "a", "start_utc": at(0), "price": "$1"}, {"uid": "b", "source_label": "k", "start_utc": at(0), "price": "$2"}]
    assert resolve.dedupe(events(spark, *both), conf, owner).first().price == "$2"
    near = resolve.scored_pairs(events(spark, {"uid": "a", "start_utc": at(0), "title": "Intro to Welding"}, {"uid": "b", "start_utc": at(1), "title": "Introduction to Welding"}), False).first()
    assert near.outcome == "near_miss_score"


def test_upsert(spark):
    cols = "uid string, title string, content_hash string, first_seen timestamp, last_seen timestamp"
    old = spark.createDataFrame([("a", "A", "1", at(0), at(0), at(0)), ("b", "B", "1", at(0), at(0), at(0)), ("c", "C", "1", at(0), at(0), at(0))], cols + ", last_changed_at timestamp")
    new = spark.createDataFrame([("b", "B", "1", None, None), ("c", "C2", "2", None, None), ("d", "D", "1", None, None)], cols)
    got = {r.uid: r for r in state.upsert(old, new, F.lit(at(60))).collect()}
    assert {k: v.change for k, v in got.items()} == {"a": "kept", "b": "unchanged", "c": "changed", "d": "new"}
    assert got["c"].first_seen == at(0) and got["c"].last_changed_at == at(60) and got["b"].last_changed_at == at(0) and got["a"].last_seen == at(0) and got["d"].first_seen == at(60) and got["c"].title == "C2"


def history(spark, *rows):
    return spark.createDataFrame([(n, "s:l", st_, dry, count, count) for n, (st_, count, dry) in enumerate(rows, 1)], "run_id long, source_key string, status string, dry_run boolean, horizon_count long, event_count long")


def test_streaks_and_plan(spark):
    h = history(spark, ("ok", 5, False), ("failed", 0, False), ("failed", 0, True), ("error", 0, False))
    assert state.failure_streak(h).first().streak == 2
    assert state.zero_streak(history(spark, ("ok", 3, False), ("ok", 0, False), ("failed", 0, False), ("ok", 0, False))).first().streak == 2
    assert state.previous_count(h, F.lit(4)).first().previous_count == 5
    many = history(spark, ("ok", 9, False), *[("failed", 0, False)] * 13, ("ok", 7, False))
    assert state.previous_count(many, F.lit(15)).first().previous_count == 0  # the answered night lies beyond the limit
    tonight = lambda s: spark.createDataFrame([("s:l", s, 0)], "source_key string, status string, transport_failures int")
    stored = spark.createDataFrame([("s:l", "u")], "source_key string, uid string")
    action = lambda s, streak, have=stored: state.carry_forward_plan(tonight(s), spark.createDataFrame([("s:l", streak)], "source_key string, streak long"), have).first().action
    assert [action("failed", 1), action("failed", 2), action("blocked", 5), action("not_modified", 9), action("ok", 0), action("error", 0, stored.limit(0))] == ["carry", "escalate", "none", "replay", "none", "nothing_stored"]


def verdict(spark, health=None, **record):
    row = {"status": "ok", "horizon_count": 5, "event_count": 5, "previous_count": 5, "stale_days": None, "ever_nonzero": True, "carried_forward": False, "reused_unchanged": False, "escalated": False} | record
    schema = "status string, horizon_count long, event_count long, previous_count long, stale_days double, ever_nonzero boolean, carried_forward boolean, reused_unchanged boolean, escalated boolean, health struct<allow_zero:boolean,ignore_count_drop:boolean,require_nonzero_once:boolean,max_stale_days:int>"
    conf = {"allow_zero": False, "ignore_count_drop": False, "require_nonzero_once": False, "max_stale_days": None} | (health or {})
    r = gates.source_verdicts(spark.createDataFrame([(*row.values(), conf)], schema)).first()
    return r.outcome, [x.code for x in r.reasons]


def test_gates(spark):
    v = lambda *a, **k: verdict(spark, *a, **k)
    assert v() == ("ok", [])
    assert v(status="skipped") == ("not_evaluated", ["not_in_run_set"]) and v(status="blocked") == ("exempt", ["blocked_by_robots"]) and v(reused_unchanged=True, horizon_count=0) == ("ok", ["reused_unchanged"]) and v(status="failed", escalated=True) == ("degraded", ["escalated"])
    assert v(horizon_count=0) == ("blocked", ["zero_after_nonzero"]) and v({"allow_zero": True}, horizon_count=0) == ("exempt", ["allow_zero"]) and v({"require_nonzero_once": True}, horizon_count=0, ever_nonzero=False) == ("exempt", ["require_nonzero_once"])
    assert v(horizon_count=0, previous_count=None) == ("ok", ["zero_no_baseline"]) and v(horizon_count=0, previous_count=0) == ("ok", ["zero_again"])
    assert v(previous_count=11) == ("degraded", ["count_drop"]) and v(previous_count=10) == ("ok", []) and v({"ignore_count_drop": True}, previous_count=11) == ("exempt", ["ignore_count_drop"])
    assert v({"max_stale_days": 30}, stale_days=31.0) == ("blocked", ["stale_feed"]) and v({"max_stale_days": 30}) == ("ok", ["no_last_modified"]) and v(event_count=0) == ("ok", ["filtered_to_zero"])
    code = lambda cur, prev, sp=None: one(spark, gates.global_gate(F.lit(cur), F.lit(prev).cast("long"), F.lit(sp).cast("string"))["code"])[0]
    assert [code(60, 100), code(59, 100), code(5, None), code(1, 100, "s")] == ["global_ok", "global_count_drop", "global_no_baseline", "global_gate_skipped"]


def test_switches_of_a_space_reach_its_sources(spark):
    from marlstone.sources import registry

    text = "spaces: [{id: a, name: A, health: {allow_zero: true, max_stale_days: 9}, sources: [{adapter: ics, label: x, url: 'https://e.org', health: {max_stale_days: 3}}, {adapter: ics, label: y, url: 'https://e.org'}]}]"
    spaces, sources = registry.load(text, {}).frames(spark)
    got = {r.source_label: r.health for r in gates.merged_health(spaces, sources).collect()}
    assert got["x"].allow_zero and got["y"].allow_zero and (got["x"].max_stale_days, got["y"].max_stale_days) == (3, 9)


def test_titles_of_compatible_forms(spark):
    from marlstone.functions.text import normalize_title

    rows = [("Ｆｕｌｌ　ｗｉｄｔｈ！",), ("ﬁne_arts",), ("Plain, text",), (None,), ("e\u0301tude",)]
    got = [r.t for r in spark.createDataFrame(rows, "x string").select(normalize_title(F.col("x")).alias("t")).collect()]
    assert got == ["full width", "fine arts", "plain text", "", "étude"]


def test_chains_of_matches_share_no_winner(spark):
    """One event that matches both ends joins them in a cluster, but each is compared with the winner."""
    rows = [{"uid": "a", "start_utc": at(0), "title": "Welding"}, {"uid": "b", "start_utc": at(25), "title": "Welding"}, {"uid": "c", "start_utc": at(50), "title": "Welding"}, {"uid": "d", "start_utc": at(300), "title": "Welding"}]
    sources = spark.createDataFrame([], "space_id string, source_label string, trust int")
    done = resolve.merge_pass(events(spark, *rows), sources, False).collect()
    assert {r.uid: [x.uid for x in r.absorbed] for r in done} == {"a": ["b"], "c": [], "d": []}


def crowd(spark, seed, n=160):
    """Events of few titles, starts and addresses, so that many are equal, alike, or fall just short."""
    import random

    r = random.Random(seed)
    titles = ["Open Shop Night", "open shop night!", "Open Shop Nights", "Shop Night", "Intro to Welding", "Introduction to Welding", "Welding intro", "", None, "Knit", "Café Crème 12", "5f2b9a77c01de4aa", "5f2b9a77c01de4ab"]
    places = [None, "12 Main Street, Oakland", "12 main st oakland", "14 Main St Oakland", "Main St Oakland", "Oakland", "Hall 12 Main St Oakland"]
    return [{"uid": f"u{i:03}", "space_id": r.choice("ab"), "source_label": r.choice("lk"), "title": r.choice(titles), "address": r.choice(places), "off_site": r.random() < 0.3, "url": r.choice([None, "http://x"]), "start_utc": at(10 * r.randrange(14)) if r.random() < 0.97 else None} for i in range(n)]


@pytest.mark.parametrize("across", [False, True])
def test_merges_equal_those_of_all_pairs(spark, across):
    rows, trust = crowd(spark, 5 + across), {("a", "l"): 3, ("b", "k"): 2}
    conf = spark.createDataFrame([(*k, t) for k, t in trust.items()], "space_id string, source_label string, trust int")
    rich = lambda e: bool(e["address"]) + bool(e["url"])
    order = sorted(rows, key=lambda e: (-trust.get((e["space_id"], e["source_label"]), 0), e["off_site"], -rich(e), e["uid"]))

    def match(x, y):
        if x["start_utc"] is None or y["start_utc"] is None or abs(x["start_utc"] - y["start_utc"]) > dt.timedelta(minutes=30) or (x["space_id"] == y["space_id"]) == across:
            return False
        return fuzzy.title_score(x["title"], y["title"]) >= (resolve.ACROSS if across else resolve.WITHIN) and (not across or fuzzy.address_score(x["address"], y["address"]) >= resolve.ADDRESS)

    taken, want = set(), {}
    for e in order:
        if e["uid"] not in taken:
            mine = [o for o in order if o["uid"] not in taken and o is not e and match(e, o)]
            taken |= {e["uid"], *(o["uid"] for o in mine)}
            want[e["uid"]] = [(o["uid"], round(fuzzy.title_score(e["title"], o["title"]), 9)) for o in mine]
    got = {r.uid: [(x.uid, round(x.score, 9)) for x in r.absorbed] for r in resolve.merge_pass(events(spark, *rows), conf, across).collect()}
    assert got == want


def test_near_misses_are_counted_without_their_pairs(spark):
    rows = events(spark, *crowd(spark, 8, 300))
    listed, count = resolve.near_misses(resolve.scored_pairs(rows, False), most=40)
    assert [tuple(r) for r in resolve.near_miss_report(rows, most=40).collect()] == [tuple(r) for r in listed.collect()]
    assert resolve.near_miss_count(rows, most=40).first() == count.first() and count.first().found > 40


def test_twins_stand_for_one_another(spark, monkeypatch):
    """Equal events make no pairs, and titles that many events share are compared once."""
    met, real = [], resolve.matches
    monkeypatch.setattr(resolve, "matches", lambda rows, across: met.append(rows.count()) or real(rows, across))
    rows = [{"uid": f"u{i:04}", "start_utc": at(0), "title": "Open Shop" if i % 2 else "shop, OPEN"} for i in range(1000)] + [{"uid": "v", "start_utc": at(5), "title": "Open shops"}]
    done = resolve.merge_pass(events(spark, *rows), sources(spark), False).collect()
    assert met == [2] and [r.uid for r in done] == ["u0000"] and len(done[0].absorbed) == 1000 and {x.score for x in done[0].absorbed} == {100.0, fuzzy.title_score("Open Shop", "Open shops")}


@given(st.text("ab ce01!éz", max_size=24), st.text("ab ce01!éz", max_size=24), st.sampled_from([75.0, 85.0, 92.0]))
def test_no_likely_pair_is_passed_over(a, b, least):
    """What SQL computes of two profiles, here in Python."""
    x, y = (dict(zip(("key", "n", "words", "c0", "c1", "c2", "c3"), fuzzy._profile(t), strict=True)) for t in (a, b))
    spread = lambda p: [p[f"c{i}"] >> 8 * j & 255 for i in range(4) for j in range(7)]
    shared = x["n"] - sum(max(s - t, 0) for s, t in zip(spread(x), spread(y), strict=True))
    whole, parts = least / 200 * (x["n"] + y["n"]), least / (200 - least) * min(x["n"], y["n"])
    assert fuzzy.set_ratio(x["key"], y["key"]) < least or shared >= (min(whole, parts) if x["words"] & y["words"] else whole) - 1e-6


def test_bound_in_sql(spark):
    titles = ["Open Shop Night", "Shop open", "abcdef0123", "abcdef0124", "zzz", "Ünïcode ü" * 3, "x" * 400, "x" * 399 + "y"]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(titles)], "i int, s string").withColumn("t", fuzzy.title_profile("s")).persist()
    rows = t.alias("p").join(t.alias("q")).select(F.col("p.i").alias("i"), F.col("q.i").alias("j"), F.col("p.t").alias("x"), F.col("q.t").alias("y")).withColumn("may", F.expr(fuzzy.may_reach("x", "y", 85.0))).collect()
    may = {(r.i, r.j): r.may for r in rows}
    assert all(may[i, j] for i, a in enumerate(titles) for j, b in enumerate(titles) if fuzzy.title_score(a, b) >= 85)
    assert not may[0, 4] and not may[2, 4] and may[6, 7] and may[2, 3] and not may[0, 2] and all(may[i, j] == may[j, i] for i, j in may)


def test_equal_values_are_scored_once(spark):
    pairs = spark.createDataFrame([("1 N Main St", "1 North Main Street")] * 50 + [("1 N Main St", "2 N Main St"), (None, "1 N Main St")], "a string, b string")
    got = {(r.a, r.b): r.score for r in resolve.value_scores(pairs, fuzzy.address_similarity).collect()}
    assert got == {("1 N Main St", "1 North Main Street"): 100.0, ("1 N Main St", "2 N Main St"): 0.0, (None, "1 N Main St"): 0.0}
    assert resolve.value_scores(pairs, fuzzy.address_similarity).count() == 3
