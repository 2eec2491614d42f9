"""The nightly run as one composition: payloads to published artifacts.

payloads -> readers -> normalize -> filters -> upsert and carry-forward ->
dedupe -> gates -> sinks. Every stage is a DataFrame-to-DataFrame function; now
and horizon_days are parameters and no stage reads a clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.identity import source_key
from marlstone.operators import gates, normalize, resolve, rules, state
from marlstone.schemas import RAW_EVENT
from marlstone.sinks import calendar, feed, health
from marlstone.sinks.files import output_dir
from marlstone.sources import events_of, read_source, reports_of
from marlstone.staging import staged


@dataclass
class Snapshot:
    """State between runs: stored events, runs, per-source history and what a source's server last said."""

    events: DataFrame
    runs: DataFrame
    history: DataFrame
    http: DataFrame

    RUNS = "run_id long, started_at timestamp, dry_run boolean, space_filter string, event_count long, blocked boolean"
    HISTORY = "run_id long, source_key string, status string, dry_run boolean, horizon_count long, event_count long"
    HTTP = "source_key string, etag string, last_modified string, body_sha256 string, failures int"
    PARTS = ("events", "runs", "history", "http")
    KEPT = "uid string, first_seen timestamp, last_seen timestamp, last_changed_at timestamp"

    @staticmethod
    def load(spark: SparkSession, path: str | None, events_schema) -> Snapshot:
        """The newest snapshot below path, or an empty one."""
        if path and Path(path, "CURRENT").exists():
            at = Path(path, Path(path, "CURRENT").read_text().strip())
            return Snapshot(*(spark.read.parquet(f"{at}/{name}") for name in Snapshot.PARTS))
        return Snapshot(spark.createDataFrame([], events_schema), *(spark.createDataFrame([], s) for s in (Snapshot.RUNS, Snapshot.HISTORY, Snapshot.HTTP)))

    def save(self, path: str, name: str) -> None:
        """Write beside the older snapshots, then move the pointer: a broken run leaves the last one current."""
        from marlstone.sinks.files import write_atomic

        for part in Snapshot.PARTS:
            getattr(self, part).write.mode("overwrite").parquet(f"{path}/{name}/{part}")
        write_atomic(Path(path, "CURRENT"), name.encode())


@dataclass
class Run:
    events: DataFrame
    verdicts: DataFrame
    summary: DataFrame
    blocked: bool
    published: list[Path]


def collect(payloads: DataFrame, spaces: DataFrame, sources: DataFrame, now: dt.datetime, horizon_days: int, options: Mapping[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """(judged events, a report per source) of all payloads: one reader per adapter in use, which is registry-sized."""
    today, parsed = now.date(), None
    adapters = [r[0] for r in sources.where("enabled").select("adapter").distinct().sort("adapter").collect()]
    for adapter in adapters:
        mine = payloads.join(F.broadcast(sources.where(F.col("enabled") & (F.col("adapter") == adapter)).select("space_id", "source_label")), ["space_id", "source_label"], "left_semi")
        got = read_source(adapter, mine, today, horizon_days, **(options or {}).get(adapter, {}))
        parsed = got if parsed is None else parsed.unionByName(got)
    parsed = staged(parsed)
    normal = staged(normalize.normalize(events_of(parsed).select(*RAW_EVENT.names), spaces, F.lit(now)))
    return rules.apply_filters(normalize.accepted(normal), sources), reports_of(parsed)


def run(spark: SparkSession, payloads: DataFrame, spaces: DataFrame, sources: DataFrame, now: dt.datetime, out: str | Path, state_dir: str | None = None, horizon_days: int = 120, dry_run: bool = False, space: str | None = None, options: Mapping[str, dict] | None = None, preferences: list[tuple[str, str, list[str]]] = ()) -> Run:
    """One night. A dry run writes no state, and it and a single-space run write to the staging folder."""
    if space:
        spaces_in, sources = spaces.where(F.col("space_id") == space), sources.where(F.col("space_id") == space)
    else:
        spaces_in = spaces
    judged, reports = collect(payloads, spaces_in, sources, now, horizon_days, options)
    judged, stamp = staged(judged), F.lit(now)
    kept = judged.where("rule is null").drop("rule", "pattern", "hits", "kept_on_missing_location", "filters")
    key = source_key(F.col("space_id"), F.col("source_label"))
    order = sources.select("space_id", "source_label", "ordinal")
    floor = normalize.collision_floor(kept.join(F.broadcast(order), ["space_id", "source_label"], "left"), "ordinal", "start_utc").drop("ordinal")
    old = Snapshot.load(spark, state_dir, floor.withColumn("last_changed_at", F.col("last_seen")).schema)
    run_id = (old.runs.agg(F.max("run_id")).first()[0] or 0) + 1

    newest = lambda c: F.max_by(c, "fetched_at")
    outcome = payloads.groupBy("space_id", "source_label").agg(F.max("outcome").alias("outcome"), newest(F.col("headers")["etag"]).alias("etag"), newest(F.col("headers")["last-modified"]).alias("last_modified"), newest(F.sha2("body", 256)).alias("body_sha256"))
    switches = gates.merged_health(spaces_in, sources)
    records = sources.where("enabled").select("space_id", "source_label").join(switches, ["space_id", "source_label"], "left").join(reports, ["space_id", "source_label"], "left").join(outcome, ["space_id", "source_label"], "left")
    counts = floor.groupBy("space_id", "source_label").agg(F.count("*").alias("event_count"))
    status = F.when(F.col("outcome") == "not_modified", "not_modified").when(F.col("outcome") == "blocked", "blocked").when(F.col("outcome").isNull() | (F.col("outcome") == "failed"), "failed").when(F.col("problem").isNotNull(), "failed").otherwise("ok")
    records = records.join(counts, ["space_id", "source_label"], "left").na.fill(0, ["event_count", "horizon_count"]).withColumns({"source_key": key, "status": status})
    answers = records.select("source_key", F.when(F.col("outcome").isNull() | (F.col("outcome") == "failed"), "failed").otherwise(F.col("outcome")).alias("outcome"), "etag", "last_modified", "body_sha256")
    http = staged(state.http_state(old.http, answers))
    records = staged(records.drop("etag", "last_modified", "body_sha256").join(http.select("source_key", F.col("failures").alias("transport_failures")), "source_key", "left"))

    stored = state.last_good(old.events).withColumn("source_key", key)
    plan = state.carry_forward_plan(records.select("source_key", "status", "transport_failures"), state.failure_streak(old.history), stored)
    carried = staged(state.carried_events(plan, stored, stamp, horizon_days))
    replayed = carried.where("action = 'replay'").select(*floor.columns)
    fresh = state.upsert(old.events, floor.unionByName(replayed), stamp)
    snapshot = staged(fresh)
    tonight = snapshot.where("change <> 'kept'").select(*floor.columns).unionByName(carried.where("action = 'carry'").select(*floor.columns))

    merged = resolve.dedupe(tonight, sources, preferences).drop("absorbed_within", "absorbed_across")
    audited = staged(gates.audited(normalize.collision_floor(merged, "start_utc"), stamp))
    final = audited.where("audit is null").drop("audit")

    history = old.history
    streaks = state.zero_streak(history)
    ever = state.milestones(history).select("source_key", F.lit(True).alias("ever_nonzero"))
    verdict_input = (
        records.join(state.previous_count(history, F.lit(run_id)), "source_key", "left").join(ever, "source_key", "left").join(streaks, "source_key", "left").join(plan.select("source_key", "action"), "source_key", "left")
        .withColumns({"stale_days": (F.unix_timestamp(stamp) - F.unix_timestamp("newest_change")) / 86400.0, "carried_forward": F.col("action") == "carry", "escalated": F.col("action") == "escalate", "reused_unchanged": F.col("action") == "replay"})
    )
    verdicts = staged(gates.source_verdicts(verdict_input))
    before = state.previous_total(old.runs, F.lit(run_id)).select("previous_event_count").first()
    total = final.count()
    gate = gates.global_gate(F.lit(total), F.lit(before[0] if before else None).cast("long"), F.lit(space))
    totals = gates.run_totals(verdicts).select(F.struct("*").alias("totals"))
    summary = staged(gates.assembled(verdicts, spark.range(1).select(gate.alias("reason"))).withColumns({"event_count": F.lit(total), "run_id": F.lit(run_id), "_one": F.lit(1)}).join(totals.withColumn("_one", F.lit(1)), "_one").drop("_one"))
    blocked = bool(summary.first()["blocked"])

    target, published = output_dir(out, dry_run, space), []
    published.append(health.emit(verdicts, summary, stamp, target))
    if not blocked and total:
        published += calendar.emit(final, spaces_in, target, now)
        published.append(feed.emit(feed.first_seen(final, snapshot.select("uid", "first_seen"), stamp), spaces_in, target, now))
    if state_dir and not dry_run:
        runs = old.runs.unionByName(spark.createDataFrame([(run_id, now, dry_run, space, total, blocked)], Snapshot.RUNS))
        mine = records.select(F.lit(run_id).cast("long").alias("run_id"), "source_key", "status", F.lit(dry_run).alias("dry_run"), F.col("horizon_count").cast("long"), F.col("event_count").cast("long"))
        Snapshot(snapshot.drop("change"), runs, history.unionByName(mine), http).save(state_dir, f"run-{run_id}")
    return Run(final, verdicts, summary, blocked, published)
