"""Publish gates: per-source verdicts as a reason array, the global drop gate, and the last audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.normalize import drop_reason, quarantine_reason
from marlstone.operators.state import FAILED

#: Fixed thresholds: a total may fall by this share, a source's count by that.
GLOBAL_DROP, SOURCE_DROP, REPAIR_AFTER = 0.4, 0.5, 3


def drop_fraction(previous: Column, current: Column) -> Column:
    """Null without a baseline, 0 where nothing was lost."""
    return F.when(previous.isNull() | (previous <= 0), None).when(current >= previous, F.lit(0.0)).otherwise((previous - current) / previous)


def merged_health(spaces: DataFrame, sources: DataFrame) -> DataFrame:
    """(space_id, source_label, health): switches of space or source, the source's stale limit before the space's. spaces: (space_id, health)."""
    both = sources.select("space_id", "source_label", F.col("health").alias("a")).join(F.broadcast(spaces.select("space_id", F.col("health").alias("b"))), "space_id", "left")
    either = lambda n: (F.coalesce(F.col(f"a.{n}"), F.lit(False)) | F.coalesce(F.col(f"b.{n}"), F.lit(False))).alias(n)
    return both.select("space_id", "source_label", F.struct(either("allow_zero"), either("ignore_count_drop"), either("require_nonzero_once"), F.coalesce("a.max_stale_days", "b.max_stale_days").alias("max_stale_days")).alias("health"))


def reason(code: str, blocking: bool = False, alert: bool = False) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(blocking).alias("blocking"), F.lit(alert).alias("alert"))


def source_verdicts(records: DataFrame) -> DataFrame:
    """records with outcome and reasons (code, blocking, alert) added.

    records: status, horizon_count, event_count, previous_count, stale_days,
    ever_nonzero, carried_forward, reused_unchanged, escalated, and health
    (null switches are off). Sources that did not run are settled by their
    status alone; the others pass the stale, zero and drop gates in this order.
    """
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    n, prev, limit = F.coalesce("horizon_count", F.lit(0)), F.col("previous_count"), F.col("health.max_stale_days")
    fraction = drop_fraction(prev, n)
    fell = F.coalesce(fraction > SOURCE_DROP, F.lit(False))
    stale = F.when(limit.isNull(), None).when(F.col("stale_days").isNull(), reason("no_last_modified", alert=True)).when(F.col("stale_days") > limit, reason("stale_feed", True, True))
    zero = F.when(n == 0, F.when(on("health.allow_zero"), reason("allow_zero")).when(on("health.require_nonzero_once") & ~on("ever_nonzero"), reason("require_nonzero_once")).when(prev > 0, reason("zero_after_nonzero", True, True)).when(prev.isNull(), reason("zero_no_baseline")).otherwise(reason("zero_again")))
    drop = F.when((n > 0) & fell, F.when(on("health.ignore_count_drop"), reason("ignore_count_drop")).otherwise(reason("count_drop", alert=True)))
    emptied = F.when((n > 0) & (F.coalesce("event_count", F.lit(0)) == 0), reason("filtered_to_zero"))
    gates = F.array_compact(F.array(stale, zero, drop, emptied))
    failed = F.col("status").isin(*FAILED) | on("carried_forward") | on("escalated")
    early = (
        F.when(F.col("status") == "skipped", F.array(reason("not_in_run_set"))).when(F.col("status") == "blocked", F.array(reason("blocked_by_robots"))).when(on("reused_unchanged"), F.array(reason("reused_unchanged")))
        .when(failed, F.when(on("escalated"), F.array(reason("escalated", alert=True))).otherwise(F.array(reason("carried_forward"))))
    )
    out = records.withColumn("reasons", F.coalesce(early, gates))
    has = lambda *codes: F.arrays_overlap(F.transform("reasons", lambda r: r["code"]), F.array(*[F.lit(c) for c in codes]))
    outcome = (
        F.when(has("not_in_run_set"), "not_evaluated").when(has("blocked_by_robots"), "exempt").when(has("reused_unchanged"), "ok").when(has("escalated", "carried_forward"), "degraded")
        .when(F.exists("reasons", lambda r: r["blocking"]), "blocked").when(has("allow_zero", "require_nonzero_once", "ignore_count_drop"), "exempt").when(has("count_drop"), "degraded").otherwise("ok")
    )
    return out.withColumns({"outcome": outcome, "drop_fraction": fraction})


def global_gate(current: Column, previous: Column, space_filter: Column) -> Column:
    """struct(code, blocking, alert): blocks where the total fell by strictly more than the threshold."""
    fraction = drop_fraction(previous, current)
    return F.when(space_filter.isNotNull(), reason("global_gate_skipped")).when(fraction.isNull(), reason("global_no_baseline")).when(fraction > GLOBAL_DROP, reason("global_count_drop", True, True)).otherwise(reason("global_ok"))


def audited(events: DataFrame, now: Column, zone: str = "America/Los_Angeles") -> DataFrame:
    """events with audit: null if fit to publish, else why not. Titles are judged before the time window, unlike in normalize."""
    tz = F.coalesce("tz", F.lit(zone))
    return events.withColumn("audit", F.coalesce(quarantine_reason(F.col("title")), drop_reason(F.col("start_utc"), F.col("all_day"), F.col("end_date"), tz, tz, now)))


def assembled(verdicts: DataFrame, total: DataFrame) -> DataFrame:
    """One row for the run: blocked, and the codes of blocking, noted and alerting reasons; total: (reason) of the global gate, first."""
    each = verdicts.select(F.col("source_key").alias("k"), F.explode("reasons").alias("r")).union(total.select(F.lit("").alias("k"), F.col("reason").alias("r")))
    pick = lambda cond: F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("k", "r")))), lambda x: F.concat_ws(" ", F.nullif(x["k"], F.lit("")), x["r"]["code"]))
    return each.groupBy().agg(F.coalesce(F.bool_or("r.blocking"), F.lit(False)).alias("blocked"), pick(F.col("r.blocking")).alias("blocking"), pick(~F.col("r.blocking")).alias("notes"), pick(F.col("r.alert")).alias("alerts"))


def run_totals(records: DataFrame) -> DataFrame:
    """One row of a run's counts: spaces seen, sources that ran, were skipped, failed, carried forward or escalated, and events."""
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = F.col("status")
    return records.agg(
        F.count_distinct("space_id").alias("spaces_seen"), F.count("*").alias("sources"), F.count_if(~status.isin("skipped", "blocked", *FAILED)).alias("ran"), F.count_if(status == "skipped").alias("skipped"), F.count_if(status.isin("blocked", *FAILED)).alias("failed"),
        F.count_if(on("carried_forward")).alias("carried_forward"), F.count_if(on("escalated")).alias("escalated"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("events"),
    )


def repair_candidates(zero_streaks: DataFrame, nights: int = REPAIR_AFTER) -> DataFrame:
    return zero_streaks.where(F.col("streak") >= nights)
