"""Queries of the engine's operators over the driver's tables, each with its SQL where SQL can express it.

The tables hold no feeds, so columns stand in: an events row is an occurrence
whose space is its event_type, a part a titled item, a day of events a run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.functions import identity, text, times
from marlstone.operators import gates, normalize, resolve, rules, state
from marlstone.sinks import calendar, feed
from marlstone.sources import feeds, ics, jsondocs

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, tuple[Query, str | None]] = {}
NOW = dt.datetime(2024, 1, 16)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        REGISTERED[f.__name__] = (f, sql)
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(c: Column) -> Column:
    """A stored wall clock as an instant in UTC."""
    return c.cast("timestamp")


def plain(c: Column) -> Column:
    """An instant as the tables store times."""
    return c.cast("timestamp_ntz")


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    start, source_uid, recurring = instant(F.col("ts")), F.when(F.col("event_id") % 3 != 0, F.col("event_id").cast("string")), F.col("event_id") % 2 == 0
    none = F.lit(None).cast("string")
    return e.select(
        "event_id", identity.make_uid(F.col("event_type"), source_uid, start, F.col("props"), recurring).alias("uid"), F.col("event_type").alias("space_id"), text.clean(F.col("props")).alias("title"), identity.stamp(start).alias("stamp"),
        identity.content_hash(F.col("props"), start, F.lit(None).cast("timestamp"), F.col("user_id").cast("string"), none, none, F.col("value").cast("decimal(12,2)").cast("string")).alias("content_hash"),
    )


CANONICAL = r"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN substr(sha1(event_type || strftime(ts, '%Y%m%dT%H%M%SZ') || trim(regexp_replace(lower(props), '[^\pL\pN]+', ' ', 'g'))), 1, 16)
    WHEN event_id % 2 = 0 THEN event_type || ':' || event_id || ':' || strftime(ts, '%Y%m%dT%H%M%SZ') ELSE event_type || ':' || event_id END AS uid,
  event_type AS space_id, trim(props) AS title, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp,
  sha256(props || chr(31) || strftime(ts, '%Y%m%dT%H%M%SZ') || chr(31) || '' || chr(31) || user_id || chr(31) || '' || chr(31) || '' || chr(31) || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)) AS content_hash
FROM events"""


@query(CANONICAL)
def canonical_event(spark, sf_dir):
    return _canonical(spark, sf_dir)


@query("SELECT space_id, count(*) AS n_events, count(DISTINCT uid) AS n_uids FROM (" + CANONICAL + ") GROUP BY space_id")
def events_by_space(spark, sf_dir):
    """The flagship: canonical events, one per uid, counted by space."""
    e = _canonical(spark, sf_dir)
    return e.groupBy("space_id").agg(F.count("*").alias("n_events"), F.count_distinct("uid").alias("n_uids"))


@query(r"SELECT p_partkey, substr(sha1(p_brand || '19700101T000000Z' || trim(regexp_replace(lower(p_name), '[^\pL\pN]+', ' ', 'g'))), 1, 16) AS uid FROM part")
def hashed_uid(spark, sf_dir):
    none = F.lit(None).cast("string")
    return read(spark, sf_dir, "part").select("p_partkey", identity.make_uid(F.col("p_brand"), none, F.timestamp_seconds(F.lit(0)), F.col("p_name"), F.lit(False)).alias("uid"))


@query("SELECT uid, event_id FROM (SELECT user_id || ':' || event_type AS uid, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def collision_floor(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_type").alias("uid"), "event_id", "ts")
    return normalize.collision_floor(e, "ts", "event_id").select("uid", "event_id")


@query(r"SELECT doc_id, coalesce(lower(trim(regexp_replace(regexp_replace(text, '[^\pL\pN\pM\s]', ' ', 'g'), '\s+', ' ', 'g'))), '') AS title FROM documents")
def title_normalize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.normalize_title(F.col("text")).alias("title"))


FILTERS = {"title_excludes": ["ring"], "location_excludes": ["economy"], "categories_exclude": ["brand#13"], "title_contains": ["red", "small", "widget", "nothing"], "location_contains": ["std", "promo", "standard"], "allow": True}
JUDGED = r"""
SELECT *, CASE WHEN contains(t, 'ring') THEN 'title_excludes' WHEN state = 'present' AND contains(l, 'economy') THEN 'location_excludes' WHEN contains(c, 'brand#13') THEN 'categories_exclude'
    WHEN NOT (contains(t, 'red') OR contains(t, 'small') OR contains(t, 'widget')) THEN 'title_contains'
    WHEN state = 'present' AND NOT (contains(l, 'std') OR contains(l, 'promo') OR contains(l, 'standard')) THEN 'location_contains' END AS rule
FROM (SELECT p_partkey, lower(p_name) AS t, lower(p_type) AS l, lower(p_brand) AS c, CASE WHEN p_size % 5 = 0 THEN 'empty' ELSE 'present' END AS state FROM part)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    f = F.struct(*[arr(FILTERS[r]).alias(r) for r in rules.RULES], F.lit(True).alias("location_allow_when_missing"))
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("location_name"), F.array("p_brand").alias("categories"), f.alias("filters"), F.lit("s").alias("space_id"), F.lit("l").alias("source_label"))
    return rules.judged(p)


@query("SELECT p_partkey, rule, CASE rule WHEN 'title_excludes' THEN 'ring' WHEN 'location_excludes' THEN 'economy' WHEN 'categories_exclude' THEN 'brand#13' END AS pattern FROM (" + JUDGED + ")")
def filter_verdict(spark, sf_dir):
    return _judged(spark, sf_dir).select("p_partkey", "rule", "pattern")


def _filter_source(spark: SparkSession) -> DataFrame:
    row = {r: FILTERS[r] for r in rules.RULES} | {"location_allow_when_missing": True}
    schema = "space_id string, source_label string, filters struct<title_contains:array<string>,title_excludes:array<string>,location_contains:array<string>,location_excludes:array<string>,categories_exclude:array<string>,location_allow_when_missing:boolean>"
    return spark.createDataFrame([("s", "l", row)], schema)


@query("SELECT d.rule, count(j.rule) AS drops FROM (VALUES ('title_excludes'), ('location_excludes'), ('categories_exclude'), ('title_contains'), ('location_contains'), ('location_missing')) d(rule) LEFT JOIN (" + JUDGED + ") j ON j.rule = d.rule GROUP BY d.rule")
def filter_tallies(spark, sf_dir):
    return rules.drop_tallies(_judged(spark, sf_dir), _filter_source(spark)).select("rule", "drops")


@query("WITH j AS (" + JUDGED + r""")
SELECT d.rule, d.pattern, (SELECT count(*) FROM j WHERE CASE d.rule WHEN 'title_excludes' THEN j.rule = 'title_excludes' WHEN 'location_excludes' THEN j.rule = 'location_excludes' WHEN 'categories_exclude' THEN j.rule = 'categories_exclude'
  WHEN 'title_contains' THEN (j.rule IS NULL OR j.rule IN ('location_contains', 'location_missing')) AND contains(t, d.pattern) ELSE j.rule IS NULL AND state = 'present' AND contains(l, d.pattern) END) AS hits
FROM (VALUES ('title_excludes', 'ring'), ('location_excludes', 'economy'), ('categories_exclude', 'brand#13'), ('title_contains', 'red'), ('title_contains', 'small'), ('title_contains', 'widget'), ('title_contains', 'nothing'),
  ('location_contains', 'std'), ('location_contains', 'promo'), ('location_contains', 'standard')) d(rule, pattern)""")
def pattern_tallies(spark, sf_dir):
    return rules.pattern_tallies(_judged(spark, sf_dir), _filter_source(spark)).select("rule", "pattern", "hits")


@query("SELECT total, dropped, CAST(dropped AS DOUBLE) / total AS drop_rate, total >= 5 AND CAST(dropped AS DOUBLE) / total >= 0.9 AS loud FROM (SELECT count(*) AS total, count(rule) AS dropped FROM (" + JUDGED + "))")
def filter_loudness(spark, sf_dir):
    return rules.loud_sources(_judged(spark, sf_dir)).select("total", "dropped", "drop_rate", "loud")


@query(r"""SELECT page_id AS id, CASE WHEN url IS NULL OR trim(url) = '' THEN 'empty' WHEN regexp_matches(trim(url), '^(?i)(https?://|www\.)\S*$') THEN 'url_only' ELSE 'present' END AS state FROM pages
UNION ALL SELECT -1 - c_custkey, CASE WHEN trim(c_name) = '' THEN 'empty' WHEN regexp_matches(trim(c_name), '^(?i)(https?://|www\.)\S*$') THEN 'url_only' ELSE 'present' END FROM customer""")
def location_state(spark, sf_dir):
    a = read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), text.location_state(F.col("url")).alias("state"))
    return a.union(read(spark, sf_dir, "customer").select(-1 - F.col("c_custkey"), text.location_state(F.col("c_name"))))


@query("SELECT source_label, house_key FROM (SELECT o_custkey AS source_label, regexp_replace(lower(o_orderpriority), '[^a-z0-9]', ' ', 'g') AS house_key, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey) AS located FROM orders GROUP BY o_custkey, o_orderpriority) WHERE n * 2 > located")
def house_venue(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.lit("s").alias("space_id"), F.col("o_custkey").alias("source_label"), F.col("o_orderpriority").alias("location"))
    return normalize.house_venues(o).select("source_label", "house_key")


@query(r"""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN 'override' WHEN o_custkey % 3 = 0 THEN 'override' WHEN o_orderkey % 7 = 0 THEN 'none' ELSE 'source' END AS address_source FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 > 0
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderpriority = '1-URGENT' OR contains(o_orderpriority, 'HIGH') OR o_orderpriority = '5-LOW' THEN 'override' ELSE 'source' END FROM orders WHERE o_orderkey % 2 = 1 OR o_custkey % 3 = 0""")
def venue_resolve(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    fixed = F.when((F.col("o_orderkey") % 2 == 1) | (F.col("o_custkey") % 3 == 0), F.lit("1-URGENT"))
    place = normalize.venue(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")), fixed, F.lit("High"), F.lit("5 low"))
    return o.select("o_orderkey", place["address_source"].alias("address_source"))


@query("""SELECT event_id, CASE WHEN ts AT TIME ZONE 'UTC' < timestamptz '2024-01-15 08:00:00+00' THEN 'past' WHEN ts + INTERVAL (CASE WHEN event_id % 10 = 0 THEN 800 ELSE 0 END) DAY > timestamp '2024-01-16' + INTERVAL 730 DAY THEN 'too_far' END AS reason
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN ts ELSE ts END AS ts FROM events) WHERE event_id % 10 <> 0
UNION ALL SELECT event_id, 'too_far' FROM events WHERE event_id % 10 = 0""")
def sanity_window(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    start = instant(F.col("ts")) + F.make_dt_interval(days=F.when(F.col("event_id") % 10 == 0, 800).otherwise(0))
    zone = F.lit("America/Los_Angeles")
    return e.select("event_id", normalize.drop_reason(start, F.lit(False), F.lit(None).cast("date"), zone, zone, F.lit(NOW)).alias("reason"))


@query("SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'empty_title' WHEN length(text) > 200 THEN 'title_too_long' END AS reason FROM documents")
def quarantine(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", normalize.quarantine_reason(F.col("text")).alias("reason"))


@query("SELECT event_id, (ts AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS utc, (CAST(CAST(ts AS DATE) AS TIMESTAMP) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS day_start FROM events")
def tz_anchor(spark, sf_dir):
    zone = F.lit("America/Los_Angeles")
    return read(spark, sf_dir, "events").select("event_id", plain(times.to_utc(F.col("ts"), zone)).alias("utc"), plain(times.day_start_utc(F.to_date("ts"), zone)).alias("day_start"))


PAIRS = "SELECT a.event_id AS l, b.event_id AS r FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 30 MINUTE AND (a.ts < b.ts OR a.event_id < b.event_id)"


@query(PAIRS)
def window_pairs(spark, sf_dir):
    pairs = resolve.window_pairs(read(spark, sf_dir, "events"), F.col("user_id"), "ts", "event_id")
    return pairs.select(F.col("left.event_id").alias("l"), F.col("right.event_id").alias("r"))


@query(PAIRS + " AND a.event_type <> b.event_type")
def cross_window_pairs(spark, sf_dir):
    pairs = resolve.window_pairs(read(spark, sf_dir, "events"), F.col("user_id"), "ts", "event_id").where("left.event_type <> right.event_type")
    return pairs.select(F.col("left.event_id").alias("l"), F.col("right.event_id").alias("r"))


#: Words without a letter in common, so that SQL can say how much titles made of them differ.
WORDS = ["aaaaa", "bbbb", "cccccc", "ddd", "eeeeeee", "ff"]


def _events(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    """Events in the columns that the resolver takes; those not given are null."""
    e = read(spark, sf_dir, "events")
    have = {"uid": F.col("event_id").cast("string"), "space_id": F.col("event_type"), "source_label": F.concat(F.lit("src"), F.col("user_id") % 3), "start_utc": instant(F.col("ts")), "categories": F.array().cast("array<string>"), "content_hash": F.lit(""), "off_site": F.col("event_id") % 5 == 0, **columns}
    kinds = {"end_utc": "timestamp", "first_seen": "timestamp", "last_seen": "timestamp"}
    names = ["uid", "space_id", "source_label", "title", "start_utc", "end_utc", "location_name", "address", "url", "price", "description", "categories", "summary_line", "rrule", "first_seen", "last_seen", "content_hash", "off_site"]
    return e.select(*[have.get(n, F.lit(None).cast(kinds.get(n, "string"))).alias(n) for n in names])


def _trust(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, f"src{n}", n * 10) for s in ("view", "click", "purchase", "signup") for n in range(3)], "space_id string, source_label string, trust int")


MASKS = "(SELECT m, sum(CASE WHEN m & (1 << i) > 0 THEN n ELSE 0 END) + greatest(bit_count(m) - 1, 0) AS len, greatest(bit_count(m) - 1, 0) AS gaps FROM (SELECT CAST(range AS INTEGER) AS m FROM range(64)), (VALUES (0, 5), (1, 4), (2, 6), (3, 3), (4, 7), (5, 2)) w(i, n) GROUP BY m)"
SCORED = f"""(SELECT l, r, CASE WHEN s.m > 0 AND (a.m = 0 OR b.m = 0) THEN 100.0 ELSE greatest(100 - 100.0 * (a.len + b.len - 2 * least(a.gaps, b.gaps)) / (s.len + g + a.len + s.len + g + b.len), CASE WHEN s.m > 0 THEN 100 - 100.0 * (g + a.len) / (s.len + s.len + g + a.len) ELSE 0 END, CASE WHEN s.m > 0 THEN 100 - 100.0 * (g + b.len) / (s.len + s.len + g + b.len) ELSE 0 END) END AS score
FROM (SELECT l, r, x & y AS sm, x & ~y AS am, y & ~x AS bm, CASE WHEN x & y > 0 THEN 1 ELSE 0 END AS g FROM (SELECT l.event_id AS l, r.event_id AS r, CAST(l.event_id % 63 + 1 AS INTEGER) AS x, CAST(r.event_id % 63 + 1 AS INTEGER) AS y FROM events l JOIN events r ON {{same}} AND r.ts >= l.ts AND r.ts <= l.ts + INTERVAL 30 MINUTE AND (l.ts < r.ts OR CAST(l.event_id AS VARCHAR) < CAST(r.event_id AS VARCHAR)))) p JOIN {MASKS} s ON s.m = sm JOIN {MASKS} a ON a.m = am JOIN {MASKS} b ON b.m = bm)"""
FUZZY = SCORED.format(same="l.event_type = r.event_type")


def _worded() -> Column:
    """A title of the words whose bit the event's number has."""
    mask = F.col("event_id") % 63 + 1
    return F.array_join(F.array_compact(F.array(*[F.when(mask.bitwiseAND(1 << i) > 0, w) for i, w in enumerate(WORDS)])), " ")


@query(f"SELECT CAST(l AS VARCHAR) AS l, CAST(r AS VARCHAR) AS r, round(score, 6) AS score, CASE WHEN score >= 85 THEN 'match' WHEN score >= 75 THEN 'near_miss_score' END AS outcome FROM {FUZZY}")
def fuzzy_pairs(spark, sf_dir):
    """Within-space pairs and how they were judged."""
    pairs = resolve.scored_pairs(_events(spark, sf_dir, title=_worded()), across=False)
    return pairs.select(F.col("left.uid").alias("l"), F.col("right.uid").alias("r"), F.round("score", 6).alias("score"), "outcome")


@query(f"SELECT CAST(l AS VARCHAR) AS left_uid, CAST(r AS VARCHAR) AS right_uid, round(score, 6) AS score FROM {FUZZY} WHERE score >= 75 AND score < 85 ORDER BY score DESC, left_uid, right_uid LIMIT 500")
def near_misses(spark, sf_dir):
    """The report of pairs that fell just short: the best five hundred."""
    listed = resolve.near_miss_report(_events(spark, sf_dir, title=_worded()))
    return listed.select("left_uid", "right_uid", F.round("score", 6).alias("score"))


@query(f"SELECT count(*) AS found, greatest(count(*) - 500, 0) AS not_listed FROM {FUZZY} WHERE score >= 75 AND score < 85")
def near_miss_count(spark, sf_dir):
    return resolve.near_miss_count(_events(spark, sf_dir, title=_worded()))


def _grouped(spark: SparkSession, sf_dir: str, url: Column | None = None) -> DataFrame:
    """Events of whole hours and forty titles that no two of are alike: those of one hour and title are one event.

    Addresses begin with a number, hold one, or have none; one title has no address.
    """
    pick = F.col("user_id") % 40
    main = F.when(F.col("event_id") % 2 == 0, " Main Street, Oakland").otherwise(" main st. oakland")
    address = F.when(pick == 7, None).when(pick == 8, F.concat(F.lit("Harbor"), main)).when(pick % 2 == 0, F.concat(F.lit("Hall "), pick, main)).otherwise(F.concat(pick, main))
    return _events(spark, sf_dir, title=F.md5(pick.cast("string")), address=address, start_utc=instant(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")), url=url if url is not None else F.when(F.col("event_id") % 2 == 0, "http://example.org"))


GROUPED = """(SELECT CAST(event_id AS VARCHAR) AS uid, event_type AS space_id, user_id % 40 AS pick, user_id % 3 AS src, date_trunc('hour', ts) AS h, CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN (user_id % 3) * 10 ELSE 0 END AS trust, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS off, event_id % 2 = 0 AS even,
  CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN user_id % 40 = 7 THEN 0 ELSE 1 END AS rich FROM events)"""
SURVIVED = f"""WITH g AS (SELECT *, row_number() OVER (PARTITION BY space_id, h, pick ORDER BY trust DESC, off, rich DESC, uid) AS n, count(*) OVER (PARTITION BY space_id, h, pick) AS size, bool_or(even) OVER (PARTITION BY space_id, h, pick) AS linked FROM {GROUPED}),
f AS (SELECT *, CASE WHEN pick = 7 THEN space_id ELSE '' END AS apart, CASE WHEN linked THEN 1 ELSE 0 END + CASE WHEN pick = 7 THEN 0 ELSE 1 END AS rich2 FROM g WHERE n = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY apart, h, pick ORDER BY trust DESC, off, rich2 DESC, uid) AS n2, count(*) OVER (PARTITION BY apart, h, pick) AS size2, bool_or(linked) OVER (PARTITION BY apart, h, pick) AS linked2 FROM f)
SELECT uid, space_id, md5(CAST(pick AS VARCHAR)) AS title, CASE WHEN linked2 THEN 'http://example.org' END AS url, CAST(size - 1 AS INTEGER) AS within, CAST(size2 - 1 AS INTEGER) AS across FROM s WHERE n2 = 1"""


@query(SURVIVED)
def dedupe_survivors(spark, sf_dir):
    """Both passes: who is left, with what was filled in and how many each took in."""
    done = resolve.dedupe(_grouped(spark, sf_dir), _trust(spark))
    return done.select("uid", "space_id", "title", "url", F.size(F.coalesce("absorbed_within", F.array())).alias("within"), F.size("absorbed_across").alias("across"))


@query(f"""WITH g AS (SELECT *, CASE WHEN even THEN 'u' || uid END AS url, space_id = 'view' AND src = 1 AS pref, row_number() OVER (PARTITION BY space_id, h, pick ORDER BY trust DESC, off, rich DESC, uid) AS n FROM {GROUPED})
SELECT max(uid) FILTER (WHERE n = 1) AS uid, CASE WHEN bool_or(pref AND n = 1) THEN max(url) FILTER (WHERE n = 1) ELSE coalesce(arg_max(url, n) FILTER (WHERE pref AND url IS NOT NULL), arg_min(url, n) FILTER (WHERE url IS NOT NULL)) END AS url FROM g GROUP BY space_id, h, pick""")
def field_preferences(spark, sf_dir):
    """A source preferred for a field gives it even to a winner that has it, and a preferred winner takes none."""
    url = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("u"), "event_id"))
    return resolve.merge_pass(_grouped(spark, sf_dir, url), _trust(spark), False, [("view", "src1", ["url"])]).select("uid", "url")


TRUST = "(SELECT space_id, 'src' || n AS source_label, n * 10 AS trust FROM (VALUES ('view'), ('click'), ('purchase'), ('signup')) s(space_id), range(3) r(n))"


@query(f"""SELECT e.event_id, row_number() OVER (PARTITION BY e.user_id ORDER BY coalesce(t.trust, 0) DESC, CASE WHEN e.event_id % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN e.event_id % 2 = 0 THEN 1 ELSE 0 END DESC, CAST(e.event_id AS VARCHAR)) AS winner_rank
FROM events e LEFT JOIN {TRUST} t ON t.space_id = e.event_type AND t.source_label = 'src' || (e.user_id % 3)""")
def winner_rank(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    e = e.select("event_id", "user_id", F.col("event_id").cast("string").alias("uid"), F.col("event_type").alias("space_id"), F.concat(F.lit("src"), F.col("user_id") % 3).alias("source_label"), (F.col("event_id") % 5 == 0).alias("off_site"), (F.col("event_id") % 2 == 0).cast("int").alias("richness"))
    return resolve.ranked(resolve.trusted(e, _trust(spark)), ["user_id"]).select("event_id", "winner_rank")


@query("""WITH s AS (SELECT user_id || event_type AS uid, max(ts) AS seen, sha256(CAST(count(*) AS VARCHAR)) AS h FROM events WHERE ts < timestamp '2024-01-15' GROUP BY 1),
n AS (SELECT user_id || event_type AS uid, min(ts) AS seen, sha256(CAST(count(*) AS VARCHAR)) AS h FROM events WHERE ts >= timestamp '2024-01-15' AND user_id % 4 <> 0 GROUP BY 1)
SELECT coalesce(s.uid, n.uid) AS uid, CASE WHEN s.uid IS NOT NULL THEN s.seen ELSE n.seen END AS first_seen, CASE WHEN n.uid IS NOT NULL THEN timestamp '2024-01-16' ELSE s.seen END AS last_seen,
  CASE WHEN n.uid IS NOT NULL AND (s.uid IS NULL OR s.h <> n.h) THEN timestamp '2024-01-16' ELSE s.seen END AS last_changed_at, coalesce(n.h, s.h) AS content_hash, CASE WHEN n.uid IS NULL THEN 'kept' WHEN s.uid IS NULL THEN 'new' WHEN s.h <> n.h THEN 'changed' ELSE 'unchanged' END AS change
FROM s FULL OUTER JOIN n ON s.uid = n.uid""")
def upsert_merge(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("uid", F.concat("user_id", "event_type"))
    seen = lambda d, f: d.groupBy("uid").agg(f("ts").cast("timestamp").alias("first_seen"), F.sha2(F.count("*").cast("string"), 256).alias("content_hash"))
    old = seen(e.where("ts < timestamp_ntz'2024-01-15'"), F.max).withColumns({"last_seen": F.col("first_seen"), "last_changed_at": F.col("first_seen")})
    new = seen(e.where("ts >= timestamp_ntz'2024-01-15' and user_id % 4 <> 0"), F.min)
    merged = state.upsert(old, new, F.lit(NOW))
    return merged.select("uid", *[plain(F.col(c)).alias(c) for c in ("first_seen", "last_seen", "last_changed_at")], "content_hash", "change")


@query("SELECT event_id, event_type FROM (SELECT event_id, event_type, CAST(ts AS DATE) AS d, max(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS m FROM events) WHERE d = m")
def last_good(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return state.last_good(e, ["event_type"], "day").select("event_id", "event_type")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a source's night: the user is the source, the id the run."""
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "not_modified").when(F.col("event_type") == "view", "skipped").otherwise("ok")
    n = F.floor("value").cast("long") % 3
    return read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_key"), F.col("event_id").alias("run_id"), (F.col("event_id") % 11 == 0).alias("dry_run"), status.alias("status"), n.alias("horizon_count"), n.alias("event_count"))


HISTORY = "(SELECT CAST(user_id AS VARCHAR) AS source_key, event_id AS run_id, event_id % 11 = 0 AS dry_run, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'not_modified' WHEN 'view' THEN 'skipped' ELSE 'ok' END AS status, CAST(floor(value) AS BIGINT) % 3 AS horizon_count, CAST(floor(value) AS BIGINT) % 3 AS event_count FROM events)"


def _streak_sql(where: str, hit: str, limit: int) -> str:
    return f"""SELECT source_key, count(*) FILTER (WHERE broken = 0) AS streak FROM (SELECT source_key, sum(CASE WHEN {hit} THEN 0 ELSE 1 END) OVER (PARTITION BY source_key ORDER BY run_id DESC ROWS UNBOUNDED PRECEDING) AS broken
FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY run_id DESC) AS n FROM {HISTORY} WHERE {where}) WHERE n <= {limit}) GROUP BY source_key"""


@query(_streak_sql("NOT dry_run", "status = 'failed'", 60))
def failure_streak(spark, sf_dir):
    return state.failure_streak(_history(spark, sf_dir))


@query(_streak_sql("NOT dry_run AND status = 'ok'", "horizon_count <= 0", 30))
def zero_streak(spark, sf_dir):
    return state.zero_streak(_history(spark, sf_dir))


@query("SELECT source_key, streak FROM (" + _streak_sql("NOT dry_run AND status = 'ok'", "horizon_count <= 0", 30) + ") WHERE streak >= 3")
def repair_candidates(spark, sf_dir):
    return gates.repair_candidates(state.zero_streak(_history(spark, sf_dir)))


PREVIOUS = f"""SELECT source_key, coalesce(arg_max(horizon_count, run_id) FILTER (WHERE status IN ('ok', 'not_modified')), arg_max(horizon_count, run_id)) AS previous_count FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY run_id DESC) AS n FROM {HISTORY}) h
WHERE n <= 14 AND run_id <> (SELECT max(event_id) FROM events) GROUP BY source_key"""


@query(PREVIOUS)
def previous_count(spark, sf_dir):
    h = _history(spark, sf_dir)
    tonight = h.agg(F.max("run_id")).first()[0]
    return state.previous_count(h, F.lit(tonight))


@query(f"SELECT source_key, min(run_id) AS first_nonzero_run, max(run_id) AS last_nonzero_run, max(event_count) AS max_count, count(*) AS nonzero_runs FROM {HISTORY} WHERE event_count > 0 GROUP BY source_key")
def milestones(spark, sf_dir):
    return state.milestones(_history(spark, sf_dir))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS source_key FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT source_key FROM {HISTORY} WHERE event_count > 0)")
def never_nonzero(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("source_key"))
    return state.never_nonzero(c, state.milestones(_history(spark, sf_dir)))


DAILY = "(SELECT event_type AS source_key, CAST(date_diff('day', date '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS run_id, count(*) % 97 AS n FROM events GROUP BY ALL)"


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("source_key"), F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("run_id")).agg((F.count("*") % 97).alias("n"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per source and night with the night before as its baseline."""
    d = _daily(spark, sf_dir)
    prev = F.lag("n").over(Window.partitionBy("source_key").orderBy("run_id"))
    on = lambda c, name: c.alias(name)
    health = F.struct(on(F.col("source_key") == "view", "allow_zero"), on(F.col("source_key") == "click", "ignore_count_drop"), on(F.lit(False), "require_nonzero_once"), F.when(F.col("source_key") == "error", 20).alias("max_stale_days"))
    halved = F.when(F.col("run_id") % 7 == 0, F.floor(F.col("n") / 3).cast("long")).otherwise(F.when(F.col("run_id") % 11 == 5, 0).otherwise(F.col("n")))
    return d.withColumn("previous_count", prev).select("source_key", "run_id", F.when(F.col("run_id") % 13 == 12, "failed").otherwise("ok").alias("status"), halved.alias("horizon_count"), halved.alias("event_count"), "previous_count", F.when(F.col("run_id") % 2 == 0, F.col("run_id").cast("double")).alias("stale_days"), F.lit(True).alias("ever_nonzero"), F.lit(False).alias("carried_forward"), F.lit(False).alias("reused_unchanged"), F.lit(False).alias("escalated"), health.alias("health"))


RECORDS = f"(SELECT source_key, run_id, CASE WHEN run_id % 13 = 12 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN run_id % 7 = 0 THEN n // 3 WHEN run_id % 11 = 5 THEN 0 ELSE n END AS cur, lag(n) OVER (PARTITION BY source_key ORDER BY run_id) AS prev, CASE WHEN run_id % 2 = 0 THEN run_id END AS stale FROM {DAILY})"


@query(f"""SELECT source_key, run_id, array_to_string(list_filter([CASE WHEN status = 'failed' THEN 'carried_forward' END, CASE WHEN status = 'ok' AND source_key = 'error' THEN CASE WHEN stale IS NULL THEN 'no_last_modified' WHEN stale > 20 THEN 'stale_feed' END END,
  CASE WHEN status = 'ok' AND cur = 0 THEN CASE WHEN source_key = 'view' THEN 'allow_zero' WHEN prev > 0 THEN 'zero_after_nonzero' WHEN prev IS NULL THEN 'zero_no_baseline' ELSE 'zero_again' END END,
  CASE WHEN status = 'ok' AND cur > 0 AND prev > 0 AND prev > cur AND (prev - cur) * 1.0 / prev > 0.5 THEN CASE WHEN source_key = 'click' THEN 'ignore_count_drop' ELSE 'count_drop' END END], lambda x: x IS NOT NULL), ',') AS codes,
  CASE WHEN status = 'failed' THEN 'degraded' WHEN (source_key = 'error' AND stale > 20) OR (cur = 0 AND source_key <> 'view' AND prev > 0) THEN 'blocked' WHEN cur = 0 AND source_key = 'view' THEN 'exempt'
    WHEN cur > 0 AND prev > cur AND (prev - cur) * 1.0 / prev > 0.5 THEN CASE WHEN source_key = 'click' THEN 'exempt' ELSE 'degraded' END ELSE 'ok' END AS outcome FROM {RECORDS}""")
def gate_verdict(spark, sf_dir):
    v = gates.source_verdicts(_records(spark, sf_dir))
    return v.select("source_key", "run_id", F.array_join(F.transform("reasons", lambda r: r["code"]), ",").alias("codes"), "outcome")


@query(f"SELECT run_id, cur, coalesce(prev, -1) AS prev, CASE WHEN prev IS NULL OR prev <= 0 THEN 'global_no_baseline' WHEN cur < prev AND CAST(prev - cur AS DOUBLE) / prev > 0.4 THEN 'global_count_drop' ELSE 'global_ok' END AS code FROM (SELECT run_id, CAST(sum(cur) AS BIGINT) AS cur, CAST(lag(sum(cur)) OVER (ORDER BY run_id) AS BIGINT) AS prev FROM {RECORDS} GROUP BY run_id)")
def global_drop(spark, sf_dir):
    totals = _records(spark, sf_dir).groupBy("run_id").agg(F.sum("horizon_count").alias("cur"))
    before = totals.select((F.col("run_id") + 1).alias("run_id"), F.col("cur").alias("prev"))
    gate = gates.global_gate(F.col("cur"), F.col("prev"), F.lit(None).cast("string"))
    return totals.join(before, "run_id", "left").select("run_id", "cur", F.coalesce("prev", F.lit(-1)).alias("prev"), gate["code"].alias("code"))


PLAN_SQL = f"""WITH tonight AS (SELECT source_key, status FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY run_id DESC) AS n FROM {HISTORY}) WHERE n = 1),
prior AS ({_streak_sql("NOT dry_run AND run_id < (SELECT max(run_id) FROM " + HISTORY + " x WHERE x.source_key = h0.source_key)", "status = 'failed'", 60).replace(HISTORY + " WHERE", HISTORY + " h0 WHERE")}),
stored AS (SELECT source_key, count(*) AS c FROM {HISTORY} WHERE event_count = 2 GROUP BY 1),
j AS (SELECT t.source_key, t.status, coalesce(p.streak, 0) AS streak, coalesce(s.c, 0) AS stored_count FROM tonight t LEFT JOIN prior p USING (source_key) LEFT JOIN stored s USING (source_key))
SELECT source_key, status, CASE WHEN status = 'failed' THEN streak + 1 ELSE 0 END AS failures, stored_count, CASE WHEN status NOT IN ('failed', 'not_modified') THEN 'none' WHEN stored_count = 0 THEN 'nothing_stored' WHEN status = 'failed' AND streak + 1 >= 3 THEN 'escalate' WHEN status = 'failed' THEN 'carry' ELSE 'replay' END AS action FROM j"""


@query(PLAN_SQL)
def carry_forward_plan(spark, sf_dir):
    h = _history(spark, sf_dir)
    newest = h.groupBy("source_key").agg(F.max("run_id").alias("newest"), F.max_by("status", "run_id").alias("last_status"))
    tonight = newest.select("source_key", F.col("last_status").alias("status"), F.lit(0).alias("transport_failures"))
    prior = h.join(newest.select("source_key", "newest"), "source_key").where("run_id < newest").drop("newest")
    return state.carry_forward_plan(tonight, state.failure_streak(prior), h.where("event_count = 2"))


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 200")
def feed_top200(spark, sf_dir):
    return feed.newest(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 200, "o_orderdate", "o_orderkey")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    v = F.try_parse_json("props")
    return read(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages")
def strip_tags(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages")
def url_host(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))


TRIMMED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


@query(rf"SELECT doc_id, CASE WHEN length(t) <= 300 THEN t ELSE regexp_replace(CASE WHEN regexp_matches(substr(t, 1, 301), '(?s)^.+[ \n\t]') THEN regexp_extract(substr(t, 1, 301), '(?s)^(.*)[ \n\t]', 1) ELSE substr(t, 1, 300) END, '\s+$', '') || '…' END AS short FROM (SELECT doc_id, {TRIMMED} AS t FROM documents)")
def truncate_300(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.truncated(F.col("text"), 300).alias("short"))


@query("SELECT p_partkey, CASE WHEN p_retailprice = 0 THEN 'Free' ELSE '$' || format('{:,.2f}', p_retailprice) END AS price FROM part")
def price_text(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.money(F.col("p_retailprice")).alias("price"))


@query("SELECT conv_id, count(*) AS n, min(turn) AS first_turn, max(turn) AS last_turn, substr(sha1(string_agg(role || text, chr(10) ORDER BY turn)), 1, 16) AS digest FROM conversations GROUP BY conv_id")
def liveness_digest(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.sort_array(F.collect_list(F.struct("turn", F.concat("role", "text").alias("id")))).alias("ids"))
    return c.select("conv_id", "n", "first_turn", "last_turn", feeds.liveness_digest(F.transform("ids", lambda x: x["id"])).alias("digest"))


@query("SELECT p_partkey, strftime(unnest(generate_series(date '2024-01-01' + CAST(p_size AS INTEGER), date '2024-03-31', INTERVAL 7 DAY)), '%Y-%m-%d') AS day FROM part")
def recurrence_expand(spark, sf_dir):
    """Weekly series from a day given by the part's size through March."""
    spark.udtf.register("expand_rrule", ics.ExpandRule)
    read(spark, sf_dir, "part").selectExpr("p_partkey", "CAST(date_add(date'2024-01-01', p_size) AS TIMESTAMP_NTZ) AS start").createOrReplaceTempView("series_of_parts")
    # each distinct start goes to Python once, whatever the number of parts that have it
    return spark.sql("""WITH starts AS (SELECT DISTINCT start FROM series_of_parts),
      found AS (SELECT start, date_format(x.occurrence, 'yyyy-MM-dd') AS day FROM starts, LATERAL expand_rrule(start, 'FREQ=WEEKLY', date'2024-01-01', date'2024-03-31') x)
      SELECT p_partkey, day FROM series_of_parts JOIN found USING (start)""")


@query("SELECT s_suppkey, n_name, CASE WHEN s_nationkey % 2 = 0 THEN s_nationkey * 10 ELSE 0 END AS trust FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def trust_lookup(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select(F.col("n_name").alias("space_id"), F.lit("l").alias("source_label"), (F.col("n_nationkey") * 10).alias("trust"), "n_nationkey")
    s = read(spark, sf_dir, "supplier").join(n.select("n_nationkey", F.col("space_id")), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("source_label", F.lit("l"))
    return resolve.trusted(s, n.where("n_nationkey % 2 = 0")).select("s_suppkey", F.col("space_id").alias("n_name"), "trust")


@query("SELECT event_id, '[' || event_type || '] ' || props AS summary, strftime(ts, '%A, %B ') || CAST(day(ts) AS VARCHAR) || strftime(ts, ', %Y, ') || CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS VARCHAR) || strftime(ts, ':%M %p') AS date_text FROM events")
def event_text(spark, sf_dir):
    """Summary and human date of every event."""
    e = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("space_name"), F.col("props").alias("title"), instant(F.col("ts")).alias("start"))
    return e.select("event_id", calendar.summary().alias("summary"), times.event_date_text(F.col("start"), F.lit("UTC")).alias("date_text"))


@query("SELECT event_type AS space_id, count(*) FILTER (WHERE audit IS NULL) AS kept, count(*) FILTER (WHERE audit = 'past') AS past, count(*) FILTER (WHERE audit = 'empty_title') AS empty FROM (SELECT event_type, CASE WHEN event_id % 7 = 0 THEN 'empty_title' WHEN ts < timestamp '2024-01-15 08:00:00' THEN 'past' END AS audit FROM events) GROUP BY 1")
def publish_audit(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("space_id"), F.when(F.col("event_id") % 7 > 0, F.col("props")).alias("title"), instant(F.col("ts")).alias("start_utc"), F.lit(False).alias("all_day"), F.lit(None).cast("date").alias("end_date"), F.lit(None).cast("string").alias("tz"))
    return gates.audited(e, F.lit(NOW)).groupBy("space_id").agg(F.count_if(F.col("audit").isNull()).alias("kept"), F.count_if(F.col("audit") == "past").alias("past"), F.count_if(F.col("audit") == "empty_title").alias("empty"))


@query("SELECT event_type AS space_id, CASE WHEN ts < timestamp '2024-01-15' THEN 'dropped' ELSE 'event' END AS disposition, CASE WHEN ts < timestamp '2024-01-15' THEN 'past' END AS reason, count(*) AS n, count(DISTINCT event_id) AS uids FROM events GROUP BY ALL")
def normalized_events(spark, sf_dir):
    """The whole normalization over the events table, counted by disposition and reason."""
    from marlstone.schemas import RAW_EVENT

    e = read(spark, sf_dir, "events")
    have = {"space_id": F.col("event_type"), "source_label": F.lit("table"), "source_uid": F.col("event_id").cast("string"), "title": F.col("props"), "start_local": F.col("ts"), "location": F.concat(F.lit("Hall "), F.col("user_id") % 4), "dtstart_form": F.lit("floating")}
    raws = e.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_EVENT.fields])
    spaces = spark.createDataFrame([(s, s.title(), None, "America/Los_Angeles", None, i) for i, s in enumerate(("click", "error", "purchase", "signup", "view"))], "space_id string, name string, url string, timezone string, address_override string, ordinal int")
    return normalize.normalize(raws, spaces, F.lit(NOW)).groupBy("space_id", "disposition", "reason").agg(F.count("*").alias("n"), F.count_distinct("uid").alias("uids"))


@query("SELECT event_type AS space_id, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN date '2024-01-16' AND date '2024-01-26' GROUP BY 1")
def json_items(spark, sf_dir):
    """The embedded-document reader over the events' props as documents."""
    docs = read(spark, sf_dir, "events").select(F.col("event_type").alias("space_id"), F.lit("props").alias("source_label"), F.lit(None).cast("string").alias("problem"), F.concat(F.lit('{"items": [{"id": "'), "event_id", F.lit('", "name": "x", "start": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"}]}')).alias("doc"))
    shape = jsondocs.Shape(items="items", uid="id", title="name", starts="start", zone="UTC")
    return jsondocs.read_items(docs, shape, NOW.date(), 10).where("in_horizon").groupBy("space_id").agg(F.count("*").alias("n"))


def queries() -> dict[str, Query]:
    from marlstone.plans import feed_queries  # noqa: F401  registers its queries

    return {name: f for name, (f, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}
