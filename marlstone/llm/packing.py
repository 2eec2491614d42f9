"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are tokenized once; every full sequence is cut off, and what remains
of each document is a piece in a length class. Patterns of classes that fit a
sequence are the columns of a linear program over the class histogram: its dual
prices feed a knapsack dynamic program that finds the next pattern, until none
pays. Rounded patterns, completed by first-fit-decreasing patterns for what
rounding leaves, are assigned to the documents by their rank in the class. The
driver only sees the histogram (at most ``capacity / grain`` numbers).
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import lean, saved, sliced

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
END_ID = 1
#: Characters of white space in a row from which the full tokenizer takes over: the fast one's pattern engine keeps a stack as deep.
LONG_GAP = 2000
GAP = re.compile(r"\s{2,}")
#: Most parts that the rows of a length class are dealt into; their size grows beyond that.
MOST_SALTS = 10_000


@functools.lru_cache(maxsize=2)
def _encoder(name: str):
    """Ids of a text as numpy uint32: byte pair ranks for ordinary texts, the full tokenizer where a special token's string or a very long gap occurs."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    full = functools.cache(lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))  # seldom needed, and large

    def encode(text: str) -> np.ndarray:
        whole = "<|" in text or (len(text) >= LONG_GAP and any(m.end() - m.start() >= LONG_GAP for m in GAP.finditer(text)))
        ids = full().encode(text, add_special_tokens=False).ids if whole else fast.encode_ordinary(text)
        return np.array(ids, np.uint32)

    return encode


def pieces(docs: DataFrame, capacity: int, tokenizer: str) -> DataFrame:
    """One row per piece: full sequences first, then the remainder; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for b in sliced(batches):
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                raw, n = ids.tobytes(), len(ids)
                rows += [(doc, a, min(capacity, n - a), zlib.crc32(raw[4 * a : 4 * (a + capacity)]), n) for a in range(0, n, capacity)]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within room of the greatest total price: unbounded knapsack by dynamic programming."""
    worth, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        k = np.searchsorted(sizes, c, "right")
        worth[c] = worth[c - 1]
        if k:
            got = prices[:k] + worth[c - sizes[:k]]
            i = int(got.argmax())
            if got[i] > worth[c] + 1e-12:
                worth[c], choice[c] = got[i], i
    taken, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            taken[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(worth[room]), taken


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses them: revised simplex, columns priced by best_pattern."""
    m = len(sizes)
    columns = [np.eye(m, dtype=np.int64)[i] * (room // sizes[i]) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag(1.0 / (room // sizes))
    used = inverse @ demand
    for _ in range(rounds):
        prices = cost @ inverse
        if prices.min() < -1e-9:  # a surplus column: more of a class than asked for
            i = int(prices.argmin())
            column, price = -np.eye(m, dtype=np.int64)[i], 0.0
        else:
            value, column = best_pattern(prices, sizes, room)
            price = 1.0
            if used @ cost * (1 - 1 / max(value, 1)) < max(0.5, 1e-4 * (used @ cost)):
                break  # by Farley's bound the optimum is as near as that
        turn = inverse @ column
        ok = turn > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, used / np.where(ok, turn, 1), np.inf)
        out = int(ratio.argmin())
        pivot = inverse[out] / turn[out]
        inverse -= np.outer(turn, pivot)
        inverse[out] = pivot
        used = np.maximum(used - turn * ratio[out], 0)
        used[out] = ratio[out]
        columns[out], cost[out] = column, price
    return [(c, float(x)) for c, x, k in zip(columns, used, cost, strict=True) if k and x > 1e-9]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {class: pieces} and their numbers of sequences that hold every piece of the histogram."""
    sizes = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    found: list[tuple[dict[int, int], int]] = []

    def take(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        found.append(({int(s): int(a) for s, a in zip(sizes, pattern, strict=True) if a}, times))
        left = np.maximum(left - pattern * times, 0)

    for pattern, times in sorted(column_generation(sizes, left.astype(float), room), key=lambda x: -x[1]) if len(sizes) else []:
        whole = int(times + 1e-9)
        if whole:
            take(pattern, whole)
    while left.any():
        space, pattern = room, np.zeros(len(sizes), np.int64)
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], space // sizes[i])
            space -= pattern[i] * sizes[i]
        take(pattern, int((left[pattern > 0] // pattern[pattern > 0]).min()))
    return found


def pack(docs: DataFrame, capacity: int = 2048, grain: int = 8, tokenizer: str = "byte_bpe_50k", rank_rows: int = 1000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's and then END_ID; null and empty texts have
    that one id. Every id lies in one piece, and a sequence holds at most
    capacity ids. Repeated rows are packed each for itself, extra columns are
    ignored, and an empty table gives an empty result. grain: width of a length
    class, so at most grain-1 ids are lost per remainder. A class is ranked in
    parts of about rank_rows rows, so that one length held by many documents
    is not one task.
    """
    room = capacity // grain
    cut = saved(pieces(docs, capacity, tokenizer))
    cut = cut.withColumn("cls", F.ceil(F.col("length") / grain).cast("int"))
    totals = {r["cls"]: r["count"] for r in cut.groupBy("cls").count().collect()}  # at most room rows
    spark, rows, base = docs.sparkSession, [], 0
    seen: dict[int, int] = dict.fromkeys(totals, 0)
    for pattern, times in plan(totals, room):
        for cls, each in pattern.items():
            rows.append((cls, seen[cls], seen[cls] + each * times, each, base))
            seen[cls] += each * times
        base += times
    plans = F.broadcast(spark.createDataFrame(rows, "p_cls int, p_from long, p_to long, p_each long, p_base long").coalesce(1))  # bounded by room squared
    salts = F.array(*[F.lit(max(1, min(-(-totals.get(c, 0) // rank_rows), MOST_SALTS))) for c in range(room + 1)])
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.get(salts, F.col("cls"))).cast("int"))
    counts = cut.groupBy("cls", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("cls", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("cls", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))  # rows equal in all of these are the same piece twice
    ranked = cut.withColumn("own", own).join(offsets, ["cls", "salt"]).withColumn("rank", F.col("first") + F.col("own") - 1)
    placed = ranked.join(plans, (F.col("cls") == F.col("p_cls")) & (F.col("rank") >= F.col("p_from")) & (F.col("rank") < F.col("p_to")))
    placed = placed.withColumn("sequence_id", (F.col("p_base") + F.floor((F.col("rank") - F.col("p_from")) / F.col("p_each"))).cast("long"))
    upto = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(upto), F.lit(0)).cast("long")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
