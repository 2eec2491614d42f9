"""Two-pass external shuffle into shards.

Pass one scatters the records by seeded hashes: rendezvous hashing of the id
names the shard (a further shard only takes rows into itself), a second hash a
bucket of the shard that fits in memory. Pass two puts each bucket's rows in
sorted order, permutes them by Fisher and Yates' inside-out shuffle, whose draws
are hashes of (seed, shard, bucket, step), and writes them. So a row's slot
follows from the rows, the number of shards and the seed, and not from partitions,
tasks or retries. Buckets follow each other in the shard. Built from DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.llm.common import saved

#: Text bytes and rows of a bucket, on average: a bucket is one array while it is permuted, in time that grows with the square of its rows.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 1000
#: Bytes of a task that permutes and writes buckets, and the most tasks, beyond which their share grows.
TASK_BYTES, MOST_TASKS = 8 << 20, 100_000


def _best(key: Column, shards: int, seed: int) -> Column:
    return F.array_max(F.array(*[F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)).alias("w"), F.lit(s).alias("s")) for s in range(shards)]))


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard with the highest hash of (seed, key, shard)."""
    return _best(key, shards, seed)["s"]


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def fisher_yates(n: Column, *draw_by: Column) -> Column:
    """A permutation of 0 to n-1, by the inside-out shuffle: step i puts i where j <= i stood, and what stood there at the end."""

    def step(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*draw_by, i), i + 1).cast("int")
        moved = F.concat(F.slice(a, F.lit(1), j), F.array(i), F.slice(a, j + 2, i - j - 1), F.array(F.get(a, j)))
        return F.when(j == i, F.array_append(a, i)).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.array().cast("array<int>"), step)


def external_shuffle(docs: DataFrame, shards: int, seed: int = 20240607, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs in shuffled order: all its columns plus shard (int) and slot (long, gapless from 0 in each shard).

    The shard follows from key and the number of shards alone. Rows with a null
    key share a shard, null and empty texts count 16 bytes, repeated rows are
    all kept (beyond a bucket's rows, equal rows are counted and dealt over
    buckets). An empty table gives an empty result. Columns of docs that are
    named shard or slot are replaced; all columns must be orderable.
    """
    docs = docs.drop("shard", "slot")
    rec = F.struct(*[docs[c] for c in docs.columns])
    placed = docs.select(rec.alias("rec"), shard_of(F.col(key), shards, seed).alias("shard"), F.xxhash64(F.lit(seed + 1), *[docs[c] for c in docs.columns]).alias("h"), record_size(F.col(text)).alias("bytes"))
    keys = saved(placed.select("shard", "h", "bytes"))
    largest, most, total = keys.groupBy("shard").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).agg(F.max("b"), F.max("n"), F.sum("b")).first()
    buckets = max(1, -(-(largest or 0) // bucket_bytes), -(-(most or 0) // bucket_rows))
    hot = saved(keys.groupBy("h").count().where(F.col("count") > bucket_rows).select("h"))  # at most a row per bucket_rows rows
    numbered = lambda rows: rows.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    counted = keys
    if not hot.isEmpty():
        copies = placed.join(hot, "h", "left_semi").groupBy("rec", "shard", "h").agg(F.count("*").alias("n"))
        dealt = copies.select("rec", "shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("c"), "h").select("rec", "shard", F.xxhash64("h", "c").alias("h"))
        placed = placed.join(hot, "h", "left_anti").select("rec", "shard", "h").union(dealt)
        counted = placed
    placed = numbered(placed.select("rec", "shard", "h"))
    share = max(TASK_BYTES, (total or 0) // MOST_TASKS) * shards * buckets // max(1, total or 0)
    together = max(1, min(buckets, share))  # neighbouring buckets of a shard in a task, so that shards are few files
    tasks = shards * -(-buckets // together)
    counts = numbered(counted).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    near = placed.withColumn("near", F.floor(F.col("bucket") / together).cast("int")).repartition(tasks, "shard", "near")
    sets = near.groupBy("shard", "near", "bucket").agg(F.sort_array(F.collect_list(F.struct(F.col(f"rec.{key}").alias("k"), F.col("rec").alias("r")))).alias("rows"))
    order = fisher_yates(F.size("rows"), F.lit(seed + 2), F.col("shard"), F.col("bucket"))
    mixed = sets.select("shard", "bucket", "rows", order.alias("order")).select("shard", "bucket", F.transform("order", lambda i: F.get("rows", i)["r"]).alias("rows"))
    slots = mixed.join(offsets, ["shard", "bucket"]).select("shard", "offset", F.posexplode("rows").alias("pos", "row"))
    return slots.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns], "shard", (F.col("offset") + F.col("pos")).cast("long").alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard; the rows of a file lie in slot order."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What write_shards wrote of rows of that schema."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
