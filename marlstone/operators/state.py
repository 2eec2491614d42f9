"""Keyed state across runs: upsert, history lookups, streaks, carry-forward.

State is a set of Parquet snapshots; an update is a full outer join written as
the next snapshot. History lookups are windows with a row limit, which Spark
plans as WindowGroupLimit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.times import day_start_utc, local_day

#: Statuses by what they mean, and how far back lookups go.
ANSWERED, FAILED = ("ok", "not_modified"), ("failed", "error")
HISTORY, FAILURE_LIMIT, ZERO_LIMIT, ESCALATE_AFTER = 14, 60, 30, 3


def upsert(stored: DataFrame, incoming: DataFrame, now: Column, key: str = "uid") -> DataFrame:
    """The next snapshot of stored with incoming merged by key, and change: new, changed, unchanged or kept.

    first_seen is written once, last_changed_at moves only when content_hash
    does, last_seen is now for every incoming row; other columns come from
    incoming, so a key seen from another source moves there. Both sides hold a
    key once (see collision_floor); stored has last_changed_at as well.
    """
    columns = [c for c in incoming.columns if c != key]
    old = stored.select(key, F.struct(*[stored[c] for c in stored.columns if c != key]).alias("_old"))
    new = incoming.select(key, F.struct(*columns).alias("_new"))
    both = old.join(new, key, "full_outer")
    fresh, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    moved = ~F.col("_new.content_hash").eqNullSafe(F.col("_old.content_hash"))
    change = F.when(fresh & ~known, "new").when(fresh & moved, "changed").when(fresh, "unchanged").otherwise("kept")
    special = {
        "first_seen": F.when(known, F.col("_old.first_seen")).otherwise(F.coalesce(F.col("_new.first_seen"), now)),
        "last_seen": F.when(fresh, now).otherwise(F.col("_old.last_seen")),
        "last_changed_at": F.when(fresh & (~known | moved), now).otherwise(F.coalesce(F.col("_old.last_changed_at"), now)),
    }
    plain = [F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns if c not in special]
    return both.select(key, *plain, *[v.alias(k) for k, v in special.items()], change.alias("change"))


def last_good(events: DataFrame, by: list[str] | None = None, seen: str = "last_seen") -> DataFrame:
    """The rows of each source's newest set: those last seen when any of its rows last was."""
    by = by or ["space_id", "source_label"]
    newest = events.groupBy(*by).agg(F.max(seen).alias("_newest"))
    return events.join(newest, by).where(F.col(seen) == F.col("_newest")).drop("_newest")


def _newest_first(by: list[str]):
    return Window.partitionBy(*by).orderBy(F.desc("run_id"))


def streak(history: DataFrame, hit: Column, by: list[str], limit: int, counted: Column | None = None) -> DataFrame:
    """(by, streak): newest rows for which hit holds before the first for which it doesn't, among limit counted rows."""
    rows = history.where(counted) if counted is not None else history
    w = _newest_first(by)
    rows = rows.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= limit)
    broken = F.sum(F.when(hit, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_broken", broken).groupBy(*by).agg(F.count_if(F.col("_broken") == 0).alias("streak"))


def failure_streak(history: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Nights failed in a row, newest first."""
    return streak(history.where("not dry_run"), F.col("status").isin(*FAILED), by or ["source_key"], FAILURE_LIMIT)


def zero_streak(history: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Answered nights with nothing in the horizon in a row; other nights neither count nor break."""
    return streak(history.where("not dry_run").withColumn("_n", F.coalesce("horizon_count", F.lit(0))), F.col("_n") <= 0, by or ["source_key"], ZERO_LIMIT, F.col("status") == "ok")


def previous_count(history: DataFrame, tonight: Column, by: list[str] | None = None) -> DataFrame:
    """(by, previous_count): of the newest answered night before tonight, else of the newest night at all.

    The history limit applies before tonight's own row is taken out.
    """
    by = by or ["source_key"]
    rows = history.withColumn("_nth", F.row_number().over(_newest_first(by))).where((F.col("_nth") <= HISTORY) & (F.col("run_id") != tonight))
    answered = F.max_by("horizon_count", F.when(F.col("status").isin(*ANSWERED), F.col("run_id")))
    return rows.groupBy(*by).agg(F.coalesce(answered, F.max_by("horizon_count", "run_id")).alias("previous_count"))


def previous_total(runs: DataFrame, tonight: Column) -> DataFrame:
    """(previous_run_id, previous_event_count) of the last comparable run: at most one row."""
    recent = runs.orderBy(F.desc("run_id")).limit(HISTORY)
    usable = recent.where((F.col("run_id") != tonight) & ~F.col("dry_run") & F.col("space_filter").isNull() & (F.col("event_count") > 0))
    return usable.orderBy(F.desc("run_id")).limit(1).select(F.col("run_id").alias("previous_run_id"), F.col("event_count").alias("previous_event_count"))


def milestones(history: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First and last night with events, the most there were, and how many such nights; sources without one are absent."""
    return history.where("event_count > 0").groupBy(*(by or ["source_key"])).agg(F.min("run_id").alias("first_nonzero_run"), F.max("run_id").alias("last_nonzero_run"), F.max("event_count").alias("max_count"), F.count("*").alias("nonzero_runs"))


def never_nonzero(sources: DataFrame, found: DataFrame, by: list[str] | None = None) -> DataFrame:
    return sources.join(found, by or ["source_key"], "left_anti")


def within_horizon(now: Column, days: int) -> Column:
    """Whether an event is not over and starts by midnight of the horizon's last day, in its own zone."""
    zone = F.col("tz")
    today = local_day(now, zone)
    floor, ceiling = day_start_utc(today, zone), day_start_utc(F.date_add(today, max(days, 0)), zone)
    over = F.when(F.col("all_day") & F.col("end_date").isNotNull(), day_start_utc(F.date_add("end_date", 1), zone) <= floor).otherwise(F.col("start_utc") < floor)
    return ~over & (F.col("start_utc") <= ceiling)


def carry_forward_plan(tonight: DataFrame, streaks: DataFrame, stored: DataFrame, escalate_after: int = ESCALATE_AFTER) -> DataFrame:
    """(source_key, status, failures, stored_count, action) for tonight's sources (source_key, status, transport_failures).

    action: replay (304: the stored set is current), carry, escalate (failed too
    many nights in a row: stop and alert), nothing_stored, or none for statuses
    that never carry. stored: (source_key, ...), the last good rows.
    """
    counts = stored.groupBy("source_key").agg(F.count("*").alias("stored_count"))
    joined = tonight.join(streaks, "source_key", "left").join(counts, "source_key", "left").na.fill(0, ["streak", "stored_count"])
    failed = F.col("status").isin(*FAILED)
    failures = F.when(failed, F.greatest(F.col("streak") + 1, F.coalesce("transport_failures", F.lit(0)))).otherwise(F.lit(0))
    action = (
        F.when(~failed & (F.col("status") != "not_modified"), "none").when(F.col("stored_count") == 0, "nothing_stored")
        .when(failed & (failures >= escalate_after), "escalate").when(failed, "carry").otherwise("replay")
    )
    return joined.select("source_key", "status", failures.cast("long").alias("failures"), F.col("stored_count").cast("long").alias("stored_count"), action.alias("action"))


def carried_events(plan: DataFrame, stored: DataFrame, now: Column, horizon_days: int) -> DataFrame:
    """The stored rows that the plan republishes, clipped to the horizon."""
    return stored.join(plan.where("action in ('carry', 'replay')").select("source_key", "action"), "source_key").where(within_horizon(now, horizon_days))


def carry_losses(plan: DataFrame, stored: DataFrame, now: Column, horizon_days: int) -> DataFrame:
    """(source_key, reason, n): stored rows that the plan would republish and the horizon leaves out, as over or too_far."""
    zone = F.col("tz")
    ceiling = day_start_utc(F.date_add(local_day(now, zone), max(horizon_days, 0)), zone)
    held = stored.join(plan.where("action in ('carry', 'replay')").select("source_key"), "source_key")
    reason = F.when(F.col("start_utc") > ceiling, "too_far").when(~within_horizon(now, horizon_days), "over")
    return held.withColumn("reason", reason).where("reason is not null").groupBy("source_key", "reason").agg(F.count("*").alias("n"))


def http_state(stored: DataFrame, answers: DataFrame) -> DataFrame:
    """The next (source_key, etag, last_modified, body_sha256, failures) of each source.

    answers: a source's (source_key, outcome, etag, last_modified, body_sha256). A
    good answer replaces what is known and ends the count of failures; not
    modified keeps the validators and ends it too; a failure keeps them and counts.
    """
    old = stored.select("source_key", F.struct("etag", "last_modified", "body_sha256", "failures").alias("o"))
    new = answers.select("source_key", F.struct("outcome", "etag", "last_modified", "body_sha256").alias("n"))
    both = old.join(new, "source_key", "full_outer")
    fetched, failed = F.col("n.outcome") == "fetched", F.col("n.outcome") == "failed"
    kept = [F.when(fetched, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ("etag", "last_modified", "body_sha256")]
    count = F.when(F.col("n").isNull(), F.coalesce("o.failures", F.lit(0))).when(failed, F.coalesce("o.failures", F.lit(0)) + 1).otherwise(0)
    return both.select("source_key", *kept, count.cast("int").alias("failures"))


def with_runs(source_runs: DataFrame, runs: DataFrame) -> DataFrame:
    """Per-source history with its run's dry_run and space_filter, as the run says; rows of an unknown run are left out."""
    return source_runs.drop("dry_run", "space_filter").join(runs.select("run_id", "dry_run", "space_filter"), "run_id")


def unchanged_payloads(payloads: DataFrame, state: DataFrame) -> DataFrame:
    """payloads with outcome not_modified where the body's digest is the stored one; state: (source_key, body_sha256)."""
    hashed = payloads.withColumn("body_sha256", F.sha2("body", 256))
    old = state.select("source_key", F.col("body_sha256").alias("_old"))
    return hashed.join(old, "source_key", "left").withColumn("outcome", F.when(F.col("body_sha256") == F.col("_old"), "not_modified").otherwise(F.col("outcome"))).drop("_old")
