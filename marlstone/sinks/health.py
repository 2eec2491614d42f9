"""health.json: one document about a run, made by aggregation."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.gates import REPAIR_AFTER
from marlstone.sinks.files import write_atomic


def document(verdicts: DataFrame, run: DataFrame, now: Column) -> DataFrame:
    """One row, json. verdicts: a row per source of the registry; run: one row (see gates.assembled). Sources with a long zero streak are named as candidates for repair."""
    fields = [c for c in ("source_key", "status", "outcome", "horizon_count", "event_count", "previous_count", "drop_fraction", "stale_days", "streak", "transport_failures", "carried_forward", "escalated", "problem", "raw_count", "undated_count", "newest_change", "reasons") if c in verdicts.columns]
    broken = F.when(F.col("streak") >= REPAIR_AFTER, F.col("source_key")) if "streak" in verdicts.columns else F.lit(None).cast("string")
    listed = verdicts.groupBy().agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("sources"), F.sort_array(F.collect_list(broken)).alias("repair_candidates"))
    one = F.lit(1).alias("_one")
    both = run.select("*", one).join(listed.select("*", one), "_one").drop("_one")
    return both.select(F.to_json(F.struct(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("checked_at"), *[F.col(c) for c in run.columns], "repair_candidates", "sources")).alias("json"))


def emit(verdicts: DataFrame, run: DataFrame, now: Column, out: str | Path) -> Path:
    path = Path(out) / "health.json"
    write_atomic(path, document(verdicts, run, now).first()["json"].encode())
    return path
