"""Removal of word windows that occur more than once, by a compacted de Bruijn graph.

The graph's nodes are word k-mers, thinned to minimizers: every window of
``window`` words holds one, and equal windows the same one. Its edges are the
longer word mers from one minimizer of a text to the next. A node that occurs
more than once and always between the same two edges is nonbranching; joins
compact the edges around such nodes into paths, in as many rounds of pointer
doubling as the longest path has binary digits.

Each place where a path occurs is then read at its source coordinates: if a
BLAKE2b digest of its words is the same everywhere, all windows inside are
repeated. Windows that no such path covers (at branches and ends of paths, and
on paths of differing words, which only equal hashes of different words can
make) are looked up one by one by the digest of their own words. The hashes
that the graph is built of thus choose what is compared and decide nothing.

Texts of equal words are one text in the graph; where such a text occurs more
than once it goes as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import lean, saved, sliced

K = 8
_BASE = 0x9E3779B97F4A7C15 | 1
EMPTY = hashlib.sha256(b"").hexdigest()
#: Texts that a task remembers in order to pass over copies among its own rows.
REMEMBERED = 100_000


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (self.base, self.back))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums from which span() takes polynomial hashes."""
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.down[: len(values)], out=out[1:])
        return out

    def span(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.up[start]


_POWERS = _Powers(_BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def slid(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over each run of width values."""
    have, out = 1, x
    while have * 2 <= width:
        out = f(out[:-have], out[have:])
        have *= 2
    return f(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


class Sparse:
    """The minimizers of one text, given as words joined by single spaces: k-mer hashes, picked positions, and each window's minimizer."""

    def __init__(self, words: bytes, window: int, k: int = K):
        self.words = words
        gap = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
        self.start = np.concatenate([[0], gap + 1]) if words else np.zeros(0, np.int64)
        self.stop = np.concatenate([gap, [len(words)]]) if words else np.zeros(0, np.int64)
        self.n = len(self.start)
        self.windows = max(0, self.n - window + 1)
        if not self.windows:
            return
        letters = _POWERS.sums(np.frombuffer(words, np.uint8).astype(np.uint64) + np.uint64(1))
        self.sums = _POWERS.sums(mixed(_POWERS.span(letters, self.start, self.stop) + (self.stop - self.start).astype(np.uint64)))
        at = np.arange(self.n - k + 1)
        self.kmers = mixed(_POWERS.span(self.sums, at, at + k))
        wide = window - k + 1
        self.least = slid(self.kmers, wide, np.minimum)
        pad = np.zeros(wide - 1, np.uint64)
        self.at = np.flatnonzero(slid(np.concatenate([pad, self.least, pad]), wide, np.maximum) == self.kmers)
        # first picked position that holds the window's least k-mer
        self.order = np.searchsorted(self.at, np.arange(self.windows))

    def hashed(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of words start to stop."""
        return mixed(_POWERS.span(self.sums, start, stop) + (stop - start).astype(np.uint64))

    def digests(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Digests [span, two int64] of words start to stop."""
        words = self.words
        found = [digest(words[a:b]) for a, b in zip(self.start[start].tolist(), self.stop[stop - 1].tolist(), strict=True)]
        return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)

    def owner(self) -> np.ndarray:
        """For each window the number (in self.at) of its leftmost minimizer."""
        number = self.order.copy()
        value = self.kmers[self.at]
        while True:
            wrong = np.flatnonzero(value[number] != self.least)
            if not len(wrong):
                return number
            number[wrong] += 1


def _texts_of(b: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for text in b.column(column).to_pylist():
        yield b" ".join((text or "").encode().split())


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def _fresh(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """(rid, words) of texts that a window fits in, copies in one task passed over as far as they are remembered."""
    seen: set[bytes] = set()
    for b in sliced(batches, 1000):
        held = []
        for words in _texts_of(b, 0):
            if words.count(b" ") + 1 < window:
                continue
            rid = digest(words)
            if rid not in seen:
                if len(seen) < REMEMBERED:
                    seen.add(rid)
                held.append((rid, words))
        yield held


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches, 1000):
        rids, ns, shas = [], [], []
        for words in _texts_of(b, 1):
            rids.append(digest(words))
            ns.append(words.count(b" ") + 1 if words else 0)
            shas.append(hashlib.sha256(words).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rids, pa.binary()), pa.array(ns, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "rid", "n_words", "whole_sha256"])


def _packed(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for held in _fresh(batches, window):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.binary()), pa.array([pack.compress(r[1]) for r in held], pa.binary())], ["rid", "z"])

    return run


def _nodes(window: int, k: int) -> Callable:
    """Each minimizer of each text: its hash, the edges to its left and right, and where it is; twice: more than once in its text."""
    names = ["h", "l", "r", "rid", "pos", "t", "twice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _fresh(batches, window):
            cols: list[list[np.ndarray]] = [[] for _ in names]
            rids: list[bytes] = []
            for rid, words in held:
                s = Sparse(words, window, k)
                h, t = s.kmers[s.at], np.frombuffer(rid, np.uint64)[0]
                edges = s.hashed(s.at[:-1], s.at[1:] + k)
                ends = mixed(np.array([t, ~t], np.uint64))
                _, back, n = np.unique(h, return_inverse=True, return_counts=True)
                rids += [rid] * len(h)
                for c, x in zip(cols, (h, np.concatenate([ends[:1], edges]), np.concatenate([edges, ends[1:]]), None, s.at.astype(np.int32), np.full(len(h), t), n[back] > 1), strict=True):
                    if x is not None:
                        c.append(x)
            if rids:
                h, left, right, pos, t, twice = (np.concatenate(c) for i, c in enumerate(cols) if i != 3)
                yield pa.RecordBatch.from_arrays([_signed(h), _signed(left), _signed(right), pa.array(rids, pa.binary()), pa.array(pos), _signed(t), pa.array(twice)], names)

    return run


def compacted(inner: DataFrame) -> DataFrame:
    """(h, path) for nonbranching nodes inner (h, l, r): path is the first node of the path that shared edges make; nodes on a cycle are left out."""
    one = lambda side: inner.groupBy(side).agg(F.min("h").alias(f"h_{side}"), F.count("*").alias("n")).where("n = 1").drop("n")
    steps = one("r").join(one("l"), F.col("r") == F.col("l")).where("h_r <> h_l").select(F.col("h_l").alias("h"), F.col("h_r").alias("up"))
    first = saved(inner.select("h").join(steps, "h", "left"))  # those without a step begin a path
    now = first.select("h", F.coalesce("up", "h").alias("up"))
    for _ in range(first.count().bit_length() + 1):
        far = now.select(F.col("h").alias("up"), F.col("up").alias("far"))
        now = saved(now.join(far, "up").select("h", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved")))
        if now.where("moved").isEmpty():
            break
        now = now.drop("moved")
    return now.select("h", F.col("up").alias("path")).join(first.where("up is null").select(F.col("h").alias("path")), "path", "left_semi")


def _marked(batch: pa.RecordBatch, k: int, window: int) -> Iterator[tuple]:
    """For each row (rid, z, marks): rid, text, windows with a repeated minimizer, of these those that a path covers, and the path's places (path, first and end word)."""
    unpack = zstandard.ZstdDecompressor()
    marks = batch.column(2)
    pos, path = marks.flatten().field(0), marks.flatten().field(1)
    inner, pos, path = path.is_valid().to_numpy(zero_copy_only=False), pos.to_numpy(zero_copy_only=False), path.fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.diff(marks.offsets.to_numpy()))
    for rid, z, hi, lo in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends.tolist(), [0, *ends.tolist()], strict=False):
        s = Sparse(unpack.decompress(z), window, k)
        m = len(s.at)
        number = np.searchsorted(s.at, pos[lo:hi])
        repeated, within, own_path = np.zeros(m, bool), np.zeros(m, bool), np.zeros(m, np.int64)
        repeated[number], within[number], own_path[number] = True, inner[lo:hi], path[lo:hi]
        # runs of neighbouring nodes of one path reach from the node before to the node after
        first = within & ~(np.concatenate([[False], within[:-1]]) & (own_path == np.concatenate([[0], own_path[:-1]])))
        last = within & ~(np.concatenate([within[1:], [False]]) & (own_path == np.concatenate([own_path[1:], [0]])))
        run = np.cumsum(first) - 1
        start, stop = s.at[np.maximum(np.flatnonzero(first) - 1, 0)], s.at[np.minimum(np.flatnonzero(last) + 1, m - 1)] + k
        own, at = s.owner(), np.arange(s.windows)
        sure = within[own]
        if len(start):
            r = np.maximum(run[own], 0)
            sure = sure & (start[r] <= at) & (at + window <= stop[r])
        yield rid, s, repeated[own], sure, (own_path[first], start, stop)


def repeated_windows_removed(docs: DataFrame, window: int = 35, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every document.

    Words are runs of bytes other than space and \\t\\n\\v\\f\\r, unchanged. A word
    goes if a window of ``window`` words covers it whose words also start
    elsewhere, in any document. kept: the words left, joined by one space, where
    something was removed; null where nothing was (the text stands). Null texts
    are empty, short texts lose nothing, repeated rows count as copies of each
    other, extra columns are ignored, and an empty table gives an empty result.
    """
    source = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = source.select("text")
    rows = saved(source.mapInArrow(_rows, "doc_id long, rid binary, n_words long, whole_sha256 string"))
    copied = rows.where(F.col("n_words") >= window).groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select("rid")

    found = saved(texts.mapInArrow(_nodes(window, k), "h long, l long, r long, rid binary, pos int, t long, twice boolean"))
    least, most = [F.min(c).alias(f"{c}0") for c in "tlr"], [F.max(c).alias(f"{c}1") for c in "tlr"]
    stats = found.groupBy("h").agg(*least, *most, F.max("twice").alias("twice"))
    shared = saved(stats.where("t0 <> t1 or twice").select("h", F.col("l0").alias("l"), F.col("r0").alias("r"), ((F.col("l0") == F.col("l1")) & (F.col("r0") == F.col("r1"))).alias("inner")))
    # a table of its own, so that a join on a much repeated node can be split at runtime
    labels = saved(shared.select("h").join(compacted(shared.where("inner").select("h", "l", "r")), "h", "left"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            paths, seen = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
            for _, s, _, _, (path, start, stop) in _marked(b, k, window):
                if len(path):
                    paths.append(path)
                    seen.append(s.digests(start, stop))
            d = np.concatenate(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths)), pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1]))], ["path", "d1", "d2"])

    while True:
        marks = found.select("h", "rid", "pos").join(labels, "h").groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("pos", "path"))).alias("marks"))
        packed = texts.mapInArrow(_packed(window), "rid binary, z binary").groupBy("rid").agg(F.first("z").alias("z"))
        held = saved(packed.join(marks, "rid").select("rid", "z", "marks"))
        read = held.mapInArrow(places, "path long, d1 long, d2 long").groupBy("path").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{i}") for c in ("d1", "d2") for i, f in enumerate((F.min, F.max))])
        differing = saved(read.where("n < 2 or d10 <> d11 or d20 <> d21").select("path"))
        if differing.isEmpty():
            break
        labels = saved(labels.join(differing.withColumn("off", F.lit(True)), "path", "left").select("h", F.when(F.col("off").isNull(), F.col("path")).alias("path")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            parts: list[tuple] = []
            rids: list[bytes] = []
            for rid, s, repeated, sure, _ in _marked(b, k, window):
                at = np.flatnonzero(repeated & ~sure)
                if len(at):
                    rids += [rid] * len(at)
                    parts.append((s.digests(at, at + window), at.astype(np.int32)))
            if parts:
                d, at = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])), pa.array(rids, pa.binary()), pa.array(at)], ["g1", "g2", "rid", "at"])

    asked = saved(held.mapInArrow(windows, "g1 long, g2 long, rid binary, at int"))
    again = saved(asked.groupBy("g1", "g2").agg(F.count("*").alias("n")).where("n > 1").select("g1", "g2"))
    verified = asked.join(again, ["g1", "g2"], "left_semi").groupBy("rid").agg(F.collect_set("at").alias("verified"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            out: list[tuple] = []
            for (rid, s, repeated, sure, _), more in zip(_marked(b, k, window), b.column(3).to_pylist(), strict=True):
                gone = repeated & sure
                gone[np.array(more or [], np.int64)] = True
                step = np.zeros(s.n + 1, np.int64)
                at = np.flatnonzero(gone)
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
                stays = np.cumsum(step[:-1]) == 0
                words = b" ".join(s.words[x:y] for x, y in zip(s.start[stays].tolist(), s.stop[stays].tolist(), strict=True))
                out.append((rid, int((~stays).sum()), words.decode() if len(at) else None, hashlib.sha256(words).hexdigest()))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.string(), pa.string()), strict=True)], ["rid", "removed", "kept_", "sha"])

    cleaned = held.join(verified, "rid", "left").select("rid", "z", "marks", "verified").mapInArrow(kept, "rid binary, removed long, kept_ string, sha string")
    told = saved(cleaned.where("removed > 0").join(copied, "rid", "left_anti").unionByName(copied, allowMissingColumns=True))  # removed is null: all words go
    joined = rows.join(told.withColumn("told", F.lit(True)), "rid", "left")
    whole, part = F.col("told") & F.col("removed").isNull(), F.col("told").isNotNull()
    return joined.select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).when(part, F.col("removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        F.when(whole, F.lit(EMPTY)).when(part, F.col("sha")).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
        F.when(whole, F.lit("")).when(part, F.col("kept_")).alias("kept"),
    )
