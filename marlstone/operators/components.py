"""Connected components by alternating large-star and small-star rounds.

The rounds follow Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014). Every round is a min aggregation and an equi-join, so no node's
neighbour list meets in one task, and each round is written to a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.staging import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (u, v: long); component is the smallest node reachable.

    Self-loops, repeated edges and rows with a null end are ignored; nodes
    without an edge do not appear. An empty input gives an empty result.
    """
    now = written(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(now)
    if before[0] == 0:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        now = written(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
