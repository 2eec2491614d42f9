"""Event batches as a stream: late data clipped by a watermark, state upserted per micro-batch."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators import normalize, state
from marlstone.sinks.files import write_atomic


def upsert_stream(events: DataFrame, state_path: str, checkpoint: str, seen: str = "last_seen", **trigger) -> StreamingQuery:
    """Fold a stream of canonical events into versioned snapshots below state_path.

    Each micro-batch is merged like a nightly run at the batch's newest time in
    column seen. A batch that is replayed writes the same version again, so the
    result is that of exactly-once delivery.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark, target = batch.sparkSession, f"{state_path}/v{number}"
        now = batch.agg(F.max(seen)).first()[0]
        if now is None:
            return
        current = Path(state_path, "CURRENT")
        versions = current.read_text().split() if current.exists() else []
        before = [v for v in versions if int(v[1:]) < number]
        incoming = normalize.collision_floor(batch, F.desc(seen))
        if before:
            old = spark.read.parquet(f"{state_path}/{before[-1]}")
        else:
            old = spark.createDataFrame([], incoming.withColumn("last_changed_at", F.col("last_seen")).schema)
        state.upsert(old, incoming, F.lit(now)).drop("change").write.mode("overwrite").parquet(target)
        write_atomic(current, "\n".join([*before[-1:], f"v{number}"]).encode())

    return events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def counts_by_window(events: DataFrame, window: str = "30 minutes", late: str = "2 hours", start: str = "start_utc") -> DataFrame:
    """Events per space and window of starts; rows later than the watermark are dropped."""
    return events.withWatermark(start, late).groupBy("space_id", F.window(start, window)).agg(F.count("*").alias("n")).select("space_id", F.col("window.start").alias("window_start"), "n")
