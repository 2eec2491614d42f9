"""Near-duplicate events: blocked interval join, fuzzy scores, clusters, merge.

Blocking turns the 30-minute window into an equi-join: starts fall into
half-hour buckets and the probe side looks into the neighbouring ones. Titles are
compared before events: each two that come within a half-hour of each other once,
however many events have them, and only where their characters allow the score.
Events then meet by bucket and like title. Events that nothing tells apart stand
for one another, so pairs are those of different starts, titles or addresses.
Matches are the edges of a graph whose components decide, as ids and scores, who
absorbs whom; whole rows then meet per winner, many winners a task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.functions.fuzzy import address_similarity, key_similarity, may_reach, title_profile, token_key_of
from marlstone.functions.identity import content_hash
from marlstone.operators.components import components
from marlstone.staging import written

#: Fixed thresholds of the two passes.
WINDOW_SECONDS, WITHIN, ACROSS, ADDRESS, NEAR_MISS = 1800, 85.0, 92.0, 90.0, 10.0
#: Most near misses that a report lists.
NEAR_MISSES = 500
#: What pairs are judged by.
NARROW = ["uid", "space_id", "title", "address", "start_utc"]
#: Titles of a block that a task compares with all of it; links and rows that a task of Python holds at once.
BLOCK, LINKS, ROWS = 1000, 200_000, 20_000
#: Fields a merge may fill, in the order in which it does.
FIELDS = ["end_utc", "location_name", "address", "url", "price", "description", "categories", "summary_line", "rrule"]
HASHED = {"end_utc", "location_name", "address", "url", "description"}


def spread(df: DataFrame) -> int:
    """Partitions to deal work out to: the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def present(c: str) -> Column:
    return F.coalesce(F.size(c) > 0 if c == "categories" else F.col(c).cast("string") != "", F.lit(False))


def richness() -> Column:
    """How many mergeable fields have a value."""
    return sum((present(c).cast("int") for c in FIELDS), F.lit(0))


def trusted(events: DataFrame, sources: DataFrame) -> DataFrame:
    """events with the registry's trust of their source, 0 by default."""
    known = F.broadcast(sources.select("space_id", "source_label", F.col("trust").alias("trust")))
    return events.drop("trust").join(known, ["space_id", "source_label"], "left").na.fill(0, ["trust"])


def window_pairs(events: DataFrame, block: Column | list[Column], start: str = "start_utc", key: str = "uid", seconds: int = WINDOW_SECONDS, parts: int | None = None) -> DataFrame:
    """(left, right): each pair of rows, as structs, in one block with starts at most seconds apart, once (left is earlier; ties by key).

    parts: tasks to deal the blocks out to, where so few bytes make so many pairs that Spark would take fewer.
    """
    blocks = block if isinstance(block, list) else [block]
    names = [f"b{i}" for i in range(len(blocks))]

    def keyed(rows: DataFrame, side: str) -> DataFrame:
        at = F.unix_micros(F.col(start).cast("timestamp"))
        return rows.select(F.struct("*").alias(side), at.alias(f"{side}_at"), F.floor(at / (seconds * 1_000_000)).alias("bucket"), F.col(key).alias(f"{side}_k"), *[b.alias(n) for b, n in zip(blocks, names, strict=True)])

    right = keyed(events, "right")
    left = keyed(events, "left").withColumn("bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)))
    if parts:
        left, right = (side.repartition(parts, "bucket", *names) for side in (left, right))
    near = (F.col("right_at") - F.col("left_at")).between(0, seconds * 1_000_000) & ((F.col("left_at") < F.col("right_at")) | (F.col("left_k") < F.col("right_k")))
    return left.join(right, ["bucket", *names]).where(near).select("left", "right")


def profiled(events: DataFrame) -> DataFrame:
    """NARROW columns with t, the profile of the title, at, the start in microseconds, and bucket, its half-hour."""
    at = F.unix_micros(F.col("start_utc").cast("timestamp"))
    return events.select(*NARROW).withColumns({"t": title_profile("title"), "at": at, "bucket": F.floor(at / (WINDOW_SECONDS * 1_000_000))})


def alike_titles(rows: DataFrame, by: list[str], least: float | None) -> DataFrame:
    """(a, b, score): title keys that come within neighbouring half-hours in one block, a < b, of at least that score; None: all of them, a <= b.

    Blocks of many titles are dealt out, so that a task holds few.
    """
    spots = rows.where("at is not null").groupBy(*by, "bucket", F.col("t.key").alias("key")).agg(F.first("t").alias("t"))
    spots = written(spots if least is None else spots.where("key <> ''"))
    here, n = [*by, "bucket"], spread(rows)
    parts = spots.groupBy(*here).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    left = spots.select(*by, F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)).alias("bucket"), F.col("key").alias("a"), F.col("t").alias("x"), F.col("bucket").alias("from"))
    left = left.join(parts, here).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("parts").repartition(n, *here, "part")
    right = spots.select(*here, F.col("key").alias("b"), F.col("t").alias("y")).join(parts, here).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").repartition(n, *here, "part")
    met = left.join(right, [*here, "part"])
    if least is None:
        met = met.where("from < bucket or a <= b")
    else:
        met = met.where(f"a <> b and (from < bucket or a < b) and {may_reach('x', 'y', least)}")
    keys = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().repartition(n)
    scored = keys.withColumn("score", key_similarity("a", "b"))
    return written(scored if least is None else scored.where(F.col("score") >= least))


def value_scores(values: DataFrame, scored: Callable[[Column, Column], Column]) -> DataFrame:
    """Distinct rows (a, b) with their score: what pairs of equal values share is compared once."""
    return written(values.select("a", "b").distinct().repartition(spread(values)).withColumn("score", scored(F.col("a"), F.col("b"))))


def scored_pairs(events: DataFrame, across: bool) -> DataFrame:
    """All pairs in the window with score, address_score and outcome: match, near_miss_score, near_miss_address or null."""
    rows = written(profiled(events))
    by = [] if across else ["space_id"]
    known = alike_titles(rows, by, None)
    narrow = rows.select(*NARROW, F.col("t.key").alias("key"))
    pairs = window_pairs(narrow, F.lit(0) if across else F.col("space_id"), parts=spread(rows))
    if across:
        pairs = pairs.where("left.space_id <> right.space_id")
    pairs = pairs.withColumns({"a": F.least("left.key", "right.key"), "b": F.greatest("left.key", "right.key")}).join(known, ["a", "b"])
    ends = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in NARROW]).alias(side)
    out = pairs.select(ends("left"), ends("right"), "score")
    out = out.withColumn("address_score", address_similarity("left.address", "right.address") if across else F.lit(None).cast("double"))
    least = ACROSS if across else WITHIN
    good = F.col("score") >= least
    good = good & (F.col("address_score") >= ADDRESS) if across else good
    outcome = F.when(good, "match").when(F.col("score") >= least, "near_miss_address").when(F.col("score") >= least - NEAR_MISS, "near_miss_score")
    return out.withColumn("outcome", outcome)


def _both_ways(alike: DataFrame) -> DataFrame:
    return alike.union(alike.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def _met(rows: DataFrame, alike: DataFrame, by: list[str]) -> DataFrame:
    """(l, r, score): pairs of rows, as structs, in the window whose titles are alike (a, b, both ways); by: columns that they share besides."""
    ask = rows.withColumn("l", F.struct("uid", "at", "space_id", "address")).withColumn("bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)))
    ask = ask.join(alike, ask["t.key"] == F.col("a")).select(*by, "bucket", F.col("b").alias("key"), "l", "score")
    answer = rows.select(*by, "bucket", F.col("t.key").alias("key"), F.struct("uid", "at", "space_id", "address").alias("r"))
    near = (F.col("r.at") - F.col("l.at")).between(0, WINDOW_SECONDS * 1_000_000) & ((F.col("l.at") < F.col("r.at")) | (F.col("l.uid") < F.col("r.uid")))
    return ask.join(answer, [*by, "bucket", "key"]).where(near).select("l", "r", "score")


def matches(events: DataFrame, across: bool) -> DataFrame:
    """(u, v, score, address_score) of the matching pairs.

    Titles are matched first; addresses are then compared where titles, half-hours
    and spaces allow a match, each two of them once.
    """
    rows = written(profiled(events).where("t.key <> '' and at is not null" + (" and address is not null" if across else "")))
    by = [] if across else ["space_id"]
    alike = alike_titles(rows, by, ACROSS if across else WITHIN)
    same = rows.select(F.col("t.key").alias("a")).distinct().select("a", F.col("a").alias("b"), F.lit(100.0).alias("score"))
    pairs = _met(rows, _both_ways(alike).union(same), by)
    ends = [F.col("l.uid").alias("u"), F.col("r.uid").alias("v"), "score"]
    if not across:
        return pairs.select(*ends, F.lit(None).cast("double").alias("address_score"))
    pairs = written(pairs.where("l.space_id <> r.space_id").select(*ends, F.col("l.address").alias("a"), F.col("r.address").alias("b")))
    placed = value_scores(pairs, address_similarity).where(F.col("score") >= ADDRESS).select("a", "b", F.col("score").alias("address_score"))
    return pairs.join(placed, ["a", "b"]).select("u", "v", "score", "address_score")


def near_misses(pairs: DataFrame, most: int = NEAR_MISSES) -> tuple[DataFrame, DataFrame]:
    """(the ``most`` nearest misses of scored_pairs, best first; one row with how many there are and how many are not listed)."""
    missed = pairs.where("outcome like 'near_miss%'").select(F.col("left.uid").alias("left_uid"), F.col("right.uid").alias("right_uid"), "score", "address_score", "outcome")
    listed = missed.orderBy(F.desc(F.round("score", 6)), "left_uid", "right_uid").limit(most)
    return listed, missed.agg(F.count("*").alias("found")).select("found", F.greatest(F.col("found") - most, F.lit(0)).alias("not_listed"))


def _tallied_misses(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events profiled, near titles both ways, (uid, near, score, n): how many later events of a near title each event falls just short of).

    Events are counted, not paired: in each half-hour the events of a title are
    numbered by start, and an event takes the difference of two numbers.
    """
    rows = written(profiled(events).where("t.key <> '' and at is not null"))
    near = written(_both_ways(alike_titles(rows, ["space_id"], WITHIN - NEAR_MISS).where(F.col("score") < WITHIN)))
    mark = rows.select("space_id", "bucket", F.col("t.key").alias("near"), "at", F.lit(0).alias("late"), "uid", F.lit(0).alias("ask"), F.lit(None).cast("double").alias("score"))
    mark = mark.join(near.select(F.col("b").alias("near")).distinct(), "near", "left_semi").select(mark.columns)
    asks = rows.join(near, rows["t.key"] == F.col("a")).select("space_id", "bucket", F.col("b").alias("near"), "at", "uid", "score")
    after = asks.select("space_id", "bucket", "near", "at", F.lit(0).alias("late"), "uid", F.lit(1).alias("ask"), "score")
    until = asks.select("space_id", (F.col("bucket") + 1).alias("bucket"), "near", (F.col("at") + WINDOW_SECONDS * 1_000_000).alias("at"), F.lit(1).alias("late"), "uid", F.lit(1).alias("ask"), "score")
    spot = Window.partitionBy("space_id", "near", "bucket").orderBy("at", "late", "uid", "ask")
    passed = F.sum(1 - F.col("ask")).over(spot.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(1 - F.col("ask")).over(spot.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counted = mark.union(after).union(until).select("uid", "near", "score", "ask", F.when(F.col("late") == 1, passed).otherwise(total - passed).alias("n"))
    return rows, near, counted.where("ask = 1 and n > 0").select("uid", "near", "score", "n")


def near_miss_report(events: DataFrame, most: int = NEAR_MISSES) -> DataFrame:
    """What near_misses lists of the pairs within spaces, without making them all: only those of the ``most`` events that come first."""
    rows, near, tallied = _tallied_misses(events)
    first = tallied.groupBy(F.round("score", 6).alias("rounded"), "uid").agg(F.sum("n").alias("n")).orderBy(F.desc("rounded"), "uid").limit(most)
    left = rows.join(F.broadcast(first.select("uid", "rounded")), "uid").join(near, F.col("t.key") == F.col("a")).where(F.round("score", 6) == F.col("rounded"))
    left = left.select("space_id", F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)).alias("bucket"), F.col("b").alias("key"), "uid", "at", "score")
    right = rows.select("space_id", "bucket", F.col("t.key").alias("key"), F.col("uid").alias("right_uid"), F.col("at").alias("right_at"))
    apart = (F.col("right_at") - F.col("at")).between(0, WINDOW_SECONDS * 1_000_000) & ((F.col("at") < F.col("right_at")) | (F.col("uid") < F.col("right_uid")))
    pairs = right.join(F.broadcast(left), ["space_id", "bucket", "key"]).where(apart)
    missed = pairs.select(F.col("uid").alias("left_uid"), "right_uid", "score", F.lit(None).cast("double").alias("address_score"), F.lit("near_miss_score").alias("outcome"))
    return missed.orderBy(F.desc(F.round("score", 6)), "left_uid", "right_uid").limit(most)


def near_miss_count(events: DataFrame, most: int = NEAR_MISSES) -> DataFrame:
    """One row: how many pairs within spaces fall just short, and how many of them a report of ``most`` leaves out."""
    found = _tallied_misses(events)[2].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found"))
    return found.select("found", F.greatest(F.col("found") - most, F.lit(0)).alias("not_listed"))


RANK = ["trust", "off_site", "richness", "uid"]


def _order() -> list[Column]:
    return [F.desc("trust"), F.col("off_site").cast("int"), F.desc("richness"), F.col("uid")]


def ranked(events: DataFrame, by: list[str]) -> DataFrame:
    """events with winner_rank: trust first, then on site, then the fuller record, then uid."""
    return events.withColumn("winner_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*_order())))


def _better(row) -> tuple:
    return -row["trust"], bool(row["off_site"]), -row["richness"], row["uid"]


def absorptions(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(uid, base, score, address_score): who goes into whom. edges: matches(); nodes: RANK of every uid in them.

    By rank, each event not yet taken becomes a base and takes the untaken events
    that match it. Components of the match graph are settled side by side, with ids
    and scores alone.
    """
    many = max(spread(edges), -(-edges.count() // LINKS))  # bundles of components: a call of Python for each would cost more than its work
    bundle = lambda c: F.pmod(F.xxhash64(c), F.lit(many)).alias("bundle")
    hashed = edges.select(F.xxhash64("u").alias("u"), F.xxhash64("v").alias("v"))  # two uids of one hash share a group, no more
    found = components(hashed)
    sides = edges.join(found.select(F.col("node").alias("n"), bundle("component")), F.xxhash64("u") == F.col("n")).drop("n")
    members = nodes.select(*RANK).join(found.select("node", bundle("component")), F.xxhash64("uid") == F.col("node")).drop("node")

    def settle(own: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        near: dict[str, list[tuple]] = {}
        for u, v, score, place in links[["u", "v", "score", "address_score"]].itertuples(index=False):
            near.setdefault(u, []).append((v, score, place))
            near.setdefault(v, []).append((u, score, place))
        order = sorted(own.to_dict("records"), key=_better)
        taken, out = set(), []
        for row in order:
            if row["uid"] in taken:
                continue
            taken.add(row["uid"])
            for other, score, place in near.get(row["uid"], []):
                if other not in taken:
                    taken.add(other)
                    out.append((other, row["uid"], score, place))
        return pd.DataFrame(out, columns=["uid", "base", "score", "address_score"])

    return members.groupBy("bundle").cogroup(sides.groupBy("bundle")).applyInPandas(settle, "uid string, base string, score double, address_score double")


def _has(value) -> bool:
    return value is not None and not (isinstance(value, float) and value != value) and value is not pd.NaT and (len(value) > 0 if hasattr(value, "__len__") else True)


def _equal(a, b) -> bool:
    return a is b or (list(a) == list(b) if hasattr(a, "__len__") and hasattr(b, "__len__") else not hasattr(a, "__len__") and not hasattr(b, "__len__") and a == b)


def _merged(base: dict, others: list[dict], preferences: list[tuple[str, str, list[str]]]) -> tuple[dict, list[dict], bool]:
    """The base with what the others, by rank, give it; what each gave; and whether a hashed field changed."""
    prefers = lambda e, name: any(name in fields and (e["space_id"], e["source_label"]) == (space, label) for space, label, fields in preferences)
    kept, absorbed, changed = dict(base), [], False
    for e in others:
        filled, preferred = [], []
        for name in FIELDS:
            if prefers(base, name):
                continue
            if prefers(e, name):
                if _has(e[name]) and not _equal(e[name], kept[name]):
                    kept[name] = e[name]
                    preferred.append(name)
            elif not _has(kept[name]) and _has(e[name]):
                kept[name] = e[name]
                filled.append(name)
        for name, pick in (("first_seen", min), ("last_seen", max)):
            seen = [x for x in (kept[name], e[name]) if _has(x)]
            kept[name] = pick(seen) if seen else None
        changed = changed or bool(HASHED & {*filled, *preferred})
        absorbed.append({"uid": e["uid"], "score": e["_score"], "address_score": e["_place"], "filled": filled, "preferred": preferred})
    return kept, absorbed, changed


def _going(of: DataFrame, across: bool) -> DataFrame:
    """(uid, base, score, address_score) of ranked events with rep, the twin that stands for them.

    The first of twins is met before the others and takes what they could take, so
    they go where it goes; where it stays, they go into it within a space, and
    stay across spaces, where two of one space do not match.
    """
    reps = of.where("uid = rep")
    edges = written(matches(reps, across))
    goes = written(absorptions(edges, reps))
    rest = of.where("uid <> rep").select("uid", "rep").join(goes.select(F.col("uid").alias("rep"), "base", "score", "address_score"), "rep", "left")
    if across:
        rest = rest.where("base is not null").select("uid", "base", "score", "address_score")
    else:
        stays = F.col("base").isNull()
        rest = rest.select("uid", F.coalesce("base", "rep").alias("base"), F.when(stays, 100.0).otherwise(F.col("score")).alias("score"), "address_score")
    return goes.union(rest)


def merge_pass(events: DataFrame, sources: DataFrame, across: bool, preferences: list[tuple[str, str, list[str]]] = ()) -> DataFrame:
    """One pass: survivors with their columns plus absorbed, an array of what each took in.

    A winner keeps its uid and is compared, unmerged, with every member of its
    cluster; members that only hang on through others go on among themselves.
    """
    events = events.drop("absorbed", "winner_rank", "richness")
    ranks = trusted(events.select(*NARROW, "source_label", "off_site", *FIELDS[:2], *FIELDS[3:]), sources).withColumn("richness", richness())
    ranks = written(ranks.select(*NARROW, "trust", F.coalesce("off_site", F.lit(False)).alias("off_site"), "richness", token_key_of("title").alias("key")))
    # events of one space, start and title (and address) match the same others: the first of them stands for all
    twins = ["space_id", "start_utc", "key", *(["address"] if across else [])]
    first = F.min_by("uid", F.struct(-F.col("trust"), F.col("off_site").cast("int"), -F.col("richness"), F.col("uid")))
    some = (F.col("key") != "") & F.col("start_utc").isNotNull()  # others match nothing
    of = written(ranks.where(some).withColumn("rep", first.over(Window.partitionBy(*twins))))
    goes = written(_going(of, across))
    took = "array<struct<uid:string,score:double,address_score:double,filled:array<string>,preferred:array<string>>>"
    out_columns = events.columns
    schema = StructType([*events.schema.fields, *StructType.fromDDL(f"absorbed {took}, _rehash boolean").fields])
    bases = goes.select(F.col("base").alias("uid")).distinct()
    told = goes.select("uid", F.col("base").alias("_base"), F.col("score").alias("_score"), F.col("address_score").alias("_place"))
    alone = bases.select("uid", F.col("uid").alias("_base"), F.lit(None).cast("double").alias("_score"), F.lit(None).cast("double").alias("_place"))
    many = max(spread(events), -(-goes.count() // ROWS))
    meeting = trusted(events, sources).join(told.union(alone), "uid").withColumns({"richness": richness(), "_bundle": F.pmod(F.xxhash64("_base"), F.lit(many))})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        groups: dict[str, list[dict]] = {}
        for row in frame.drop(columns="_bundle").astype(object).where(frame.drop(columns="_bundle").notna(), None).to_dict("records"):
            groups.setdefault(row["_base"], []).append(row)
        out = []
        for uid, rows in groups.items():
            base = next(r for r in rows if r["uid"] == uid)
            kept, absorbed, changed = _merged(base, sorted((r for r in rows if r is not base), key=_better), list(preferences))
            out.append({**{c: kept[c] for c in out_columns}, "absorbed": absorbed, "_rehash": changed})
        return pd.DataFrame(out, columns=[*out_columns, "absorbed", "_rehash"])

    single = events.join(bases.union(goes.select("uid")), "uid", "left_anti").select(*out_columns, F.array().cast(took).alias("absorbed"))
    merged = meeting.groupBy("_bundle").applyInPandas(run, schema)
    fresh = content_hash(*[F.col(c) for c in ("title", "start_utc", "end_utc", "location_name", "address", "url", "description")])
    merged = merged.withColumn("content_hash", F.when(F.col("_rehash"), fresh).otherwise(F.col("content_hash"))).drop("_rehash")
    return single.unionByName(merged)


def dedupe(events: DataFrame, sources: DataFrame, preferences: list[tuple[str, str, list[str]]] = ()) -> DataFrame:
    """Both passes: within each space, then across spaces among the survivors."""
    first = written(merge_pass(events, sources, False, preferences))
    second = merge_pass(first.drop("absorbed"), sources, True, preferences)
    inner = first.select("uid", F.col("absorbed").alias("absorbed_within"))
    return second.withColumnRenamed("absorbed", "absorbed_across").join(inner, "uid", "left")
