"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marlstone.staging import shared_dir
from marlstone.staging import written as saved

__all__ = ["LOWER_AZ", "lean", "saved", "shared_dir", "sliced", "spread", "table", "unique_name"]

#: Byte table that lower-cases A-Z only.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Rows of an Arrow batch of whole texts; Spark's own 10,000 hold tens of MB several times over, in the JVM and in each worker.
BATCH_ROWS = 1000


def lean(df: DataFrame) -> DataFrame:
    """df, its session set to hand whole texts to Python in small batches unless it names a number of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(name)) == 10_000:
        conf.set(name, BATCH_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unique_name(df: DataFrame | Iterable[str], base: str) -> str:
    """A column name that clashes with none in df."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def spread(df: DataFrame) -> int:
    """Partitions to deal work out to: the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker holds few rows as Python objects; an empty batch gives none."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
