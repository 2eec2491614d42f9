"""Text reports of a run: a line per source and a closing line, made as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_line() -> Column:
    """source: status, counts, the change since last time, outcome and reason codes."""
    change = F.when(F.col("previous_count").isNull(), "new").otherwise(F.concat(F.lit("was "), F.col("previous_count").cast("string")))
    codes = F.array_join(F.transform("reasons", lambda r: F.concat(r["code"], F.when(r["blocking"], F.lit("!")).otherwise(F.lit("")))), ", ")
    head = F.concat(F.col("source_key"), F.lit(": "), F.col("status"), F.lit(", "), F.coalesce("event_count", F.lit(0)).cast("string"), F.lit(" of "), F.coalesce("horizon_count", F.lit(0)).cast("string"), F.lit(" events ("), change, F.lit("), "), F.col("outcome"))
    return F.when(codes != "", F.concat(head, F.lit(" ["), codes, F.lit("]"))).otherwise(head)


def lines(verdicts: DataFrame) -> DataFrame:
    """(source_key, line), a row per source."""
    return verdicts.select("source_key", source_line().alias("line"))


def closing(totals: DataFrame) -> DataFrame:
    """One row, line: the totals of gates.run_totals in words."""
    said = [F.concat(F.col(c).cast("string"), F.lit(f" {w}")) for c, w in (("ran", "ran"), ("skipped", "skipped"), ("failed", "failed"), ("carried_forward", "carried forward"), ("escalated", "escalated"), ("events", "events"))]
    return totals.select(F.concat_ws(", ", *said).alias("line"))
