"""SimHash near-duplicate detection with sharded BK-trees.

Fingerprints that differ in at most r bits agree on one of r+1 disjoint bands,
so the distinct fingerprints are dealt into shards by (band, value) and one
BK-tree per shard answers the radius search: no link is lost and no fingerprint
meets all others. A shard beyond ``shard_rows`` is banded again on the bits that
the first banding left open, up to three times; what is still larger (near
copies that agree almost everywhere) is cut into blocks, and each pair of blocks
becomes a shard of its own. Trees are therefore bounded at every input size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.bktree import Forest, least_labels
from marlstone.llm.common import LOWER_AZ, lean, saved, sliced, spread, unique_name
from marlstone.operators.components import components

#: Fingerprints in a tree, and about those of a task.
SHARD_ROWS, TASK_ROWS = 3000, 200_000
#: Texts that are compared with each other in one task, and about those of a task.
UNIT_ROWS, TASK_TEXTS = 1000, 2000


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased text, repeats included; fewer words: of the whole sequence; none: empty."""
    tokens = (text or "").encode().translate(LOWER_AZ).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    end = np.cumsum(size)
    start, stop = (end - size)[: len(tokens) - words + 1].tolist(), (end - 1)[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(start, stop, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Fingerprint whose bit is 1 where over half of the hashes have it."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every whole text, as a signed long. Null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            fp = np.array([majority(shingle_hashes(t, words, seed)) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _banded(df: DataFrame, bits: int, bands: int) -> DataFrame:
    """Rows of (item, fp, key, rest) once per band of their open bits; key grows by band and value, rest loses the band."""
    width, parts = bits // bands, []
    for i in range(bands):
        low = i * width
        wide = bits - low if i == bands - 1 else width
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << wide) - 1))
        above = F.shiftleft(F.shiftrightunsigned("rest", low + wide), low) if low + wide < 64 else F.lit(0).cast("long")
        rest = above.bitwiseOR(F.col("rest").bitwiseAND(F.lit((1 << low) - 1)))
        parts.append(F.struct(F.xxhash64("key", F.lit(i), value).alias("key"), rest.alias("rest"), F.lit(bits - wide).alias("bits")))
    return df.select("item", "fp", F.explode(F.array(*parts)).alias("p")).select("item", "fp", "p.key", "p.rest", "p.bits")


def shards(prints: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(item, fp, key): rows of prints (item, fp) once per shard; any two within radius share a shard of at most about 2*shard_rows rows."""
    now = prints.select("item", "fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    bits, done = 64, []
    for level in range(3):
        cut = bits // (radius + 1)
        if cut < 4:
            break
        now = saved(_banded(now, bits, radius + 1))
        hot = now.groupBy("key").count().where(F.col("count") > shard_rows)
        if level == 2 or hot.isEmpty():
            break
        hot = saved(hot)
        done.append(now.join(hot, "key", "left_anti").select("item", "fp", "key"))
        now = now.join(hot, "key", "left_semi")
        bits -= cut + bits % (radius + 1)  # the last band may be wider: later levels only use bits all have open
    left = now.select("item", "fp", "key")
    out = _blocked(left, _large(left, shard_rows))
    for part in done:
        out = out.union(part)
    return out


def _large(rows: DataFrame, shard_rows: int) -> DataFrame | None:
    """(key, n) of keys of over shard_rows rows, with the blocks to cut them into; None if there are none."""
    big = saved(rows.groupBy("key").count().where(F.col("count") > shard_rows).select("key", F.ceil(F.col("count") / shard_rows).cast("int").alias("n")))
    return None if big.isEmpty() else big


def _blocked(rows: DataFrame, big: DataFrame | None) -> DataFrame:
    """rows (item, ..., key) with every key of big cut into blocks, each pair of which becomes a key of its own."""
    if big is None:
        return rows
    others = [c for c in rows.columns if c != "key"]
    mine = F.pmod(F.xxhash64("item"), F.col("n")).cast("int")
    cut = rows.join(big, "key").select(*others, "key", mine.alias("x"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("y"))
    cut = cut.select(*others, F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("key"))
    return rows.join(big, "key", "left_anti").select(*others, "key").union(cut)


def links(sharded: DataFrame, radius: int, parts: int, second: int | None = None) -> DataFrame:
    """(u, v): for each item with a neighbour in its shard, the smallest item that the shard's links connect it to.

    parts: tasks to deal the shards out to; each holds its rows as arrays.
    second: most differing bits of a further fingerprint, fp2, for a link.
    """
    columns = ["key", "item", "fp", *(["fp2"] if second is not None else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        df = pd.concat(held, ignore_index=True)
        df = df[df.duplicated("key", keep=False)]
        if df.empty:
            return
        item, fp = df["item"].to_numpy(), df["fp"].to_numpy().view(np.uint64)
        pairs = Forest(df["key"].to_numpy(), fp).within(radius)
        if second is not None:
            other = df["fp2"].to_numpy().view(np.uint64)
            pairs = ((i[near], j[near]) for i, j in pairs if (near := np.bitwise_count(other[i] ^ other[j]) <= second).any())
        least = least_labels(len(item), pairs, item)
        far = least != item
        yield pd.DataFrame({"u": item[far], "v": least[far]}).drop_duplicates()

    return sharded.repartition(parts, "key").select(*columns).mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every document: components of fingerprints within radius.

    component_id is the smallest doc_id reachable. Null and empty texts have
    fingerprint zero and link like any other. Rows with a null doc_id keep a
    fingerprint and join components, but never name one unless alone (null).
    Repeated rows are all kept. An empty table gives an empty result; extra
    columns are ignored.
    """
    prints = saved(fingerprints(docs, words, seed))
    reps = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("item")).select("item", "fp"))
    parts = max(spread(docs), reps.count() * (radius + 1) // TASK_ROWS)
    found = components(links(shards(reps.where("item is not null"), radius, shard_rows), radius, parts))
    named = reps.join(found.withColumnRenamed("node", "item"), "item", "left").select("fp", F.coalesce("component", "item").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def _sketches(words: int, prints: int):
    salts = [np.uint64(x * 0x9E3779B97F4A7C15 % 2**64) for x in range(1, prints + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = []
            for text in b.column(2).to_pylist():
                h = np.unique(shingle_hashes(text, words))
                rows.append([np.array(majority(_salted(h, s)), np.uint64).view(np.int64).item() for s in salts])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "digest", "prints"])

    return run


def _salted(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (h ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _shingles(text: str | None, words: int) -> np.ndarray:
    """The text's distinct shingles; of a text without words the one shingle 0, so that such texts are alike."""
    h = np.unique(shingle_hashes(text, words))
    return h if len(h) else np.zeros(1, np.uint64)


def _reach(size: np.ndarray, at: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(whether, most): whether a set of size shingles, ordered as all others are, can first meet a similar one at its shingle number at, and how many shingles that one has at most."""
    most = np.floor((size - at) * (1 + similarity) / similarity + 1e-9).astype(np.int64) - size
    return at <= size - np.ceil(similarity * size - 1e-9), most


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of count numbers each, end to end."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of the sets of distinct shingles a label: equal where pairs of a Jaccard similarity of at least that connect them.

    Shingles are ordered rarest first; sets that are similar meet within their first
    shingles (prefix filter with sizes and positions), and those that do and are not yet
    connected are compared.
    """
    n = len(sets)
    label, size = np.arange(n), np.array([len(s) for s in sets], np.int64)
    start = np.cumsum(size) - size
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(seen), np.int64)
    rank[np.argsort(seen, kind="stable")] = np.arange(len(seen))
    owner, code = np.repeat(label, size), rank[code]
    code = code[np.lexsort((code, owner))]
    can, most = _reach(size[owner], np.arange(len(code)) - start[owner], similarity)
    use = can & (np.sort(seen)[code] > 1)
    mine, key, most = owner[use], code[use], most[use]
    by = np.argsort(key, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    left = np.searchsorted(key[by], key, "right") - place - 1  # later sets that have the shingle among their first, too
    first, marked = np.searchsorted(mine, np.arange(n + 1)), np.zeros(len(seen), np.int64)
    for x in range(n):
        own = slice(first[x], first[x + 1])
        if not left[own].any():
            continue
        entry = by[_ranges(place[own] + 1, left[own])]
        y = mine[entry]
        y = np.unique(y[(label[y] != label[x]) & (size[y] <= np.repeat(most[own], left[own])) & (size[x] <= most[entry])])
        if not len(y):
            continue
        shingles = code[start[x] : start[x] + size[x]]
        marked[shingles] = 1
        both = np.add.reduceat(marked[code[_ranges(start[y], size[y])]], np.cumsum(size[y]) - size[y])
        marked[shingles] = 0
        for old in np.unique(label[y[both / (size[x] + size[y] - both) >= similarity]]):
            label[label == old] = label[x]
    return label


def _grouped(words: int, similarity: float):
    """Rows (unit, cut, item, doc_id, text), ordered by unit, to (u, v, cut): each item but the first of its group within the unit, and that first one."""

    def settled(cut: bool, held: dict) -> list[tuple]:
        label = alike([s for _, s in held.values()], similarity) if len(held) > 1 else [0]
        least: dict = {}
        for group, (item, (doc_id, _)) in zip(label, held.items(), strict=True):
            rank = (doc_id is None, 0 if doc_id is None else doc_id, item)
            least[group] = min(rank, least.get(group, rank))
        return [(item, least[group][2], cut) for group, item in zip(label, held, strict=True) if item != least[group][2]]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["u", "v", "cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for b in sliced(batches):
            done = []
            for unit, cut, item, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (unit, cut) != now:
                    done += settled(now[1], held) if held else []
                    now, held = (unit, cut), {}
                if item not in held:
                    held[item] = (doc_id, _shingles(text, words))
            yield batch(done)
        yield batch(settled(now[1], held) if held else [])

    return run


#: What _dealt makes: arrays as bytes, so that a shingle is no row of its own.
_DEALT = "bucket int, a binary, b binary, c binary, d binary"


def _dealt(parts: int, by: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row per bucket (by modulo parts) with its entries of up to four columns."""
    bucket = (by % np.uint64(parts)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    have, begin = np.unique(bucket[order], return_index=True)
    end = [*begin[1:].tolist(), len(order)]
    cut = [pa.array([c[order[i:j]].tobytes() for i, j in zip(begin.tolist(), end, strict=True)], pa.binary()) for c in columns]
    cut += [pa.array([b""] * len(have), pa.binary())] * (4 - len(columns))
    return pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), *cut], ["bucket", "a", "b", "c", "d"])


def _gathered(batches: Iterator[pa.RecordBatch], types: list) -> list[np.ndarray] | None:
    """The columns that _dealt dealt to this task; None if there are none."""
    parts = [[] for _ in types]
    for b in batches:
        for part, column in zip(parts, b.columns[1:], strict=False):
            part += column.to_pylist()
    return [np.frombuffer(b"".join(p), t) for p, t in zip(parts, types, strict=True)] if any(parts[0]) else None


def _meeting(words: int, similarity: float, parts: int):
    """Three steps over (item, text): shingles by shingle; those of several items, with their number, by item; those that similar sets can first meet at, by shingle again. And the links between items that meet so."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sets = [_shingles(t, words) for t in b.column(1).to_pylist()]
                size = np.array([len(s) for s in sets], np.int64)
                yield _dealt(parts, h := np.concatenate(sets), h, np.repeat(b.column(0).to_numpy(), size), np.repeat(size, size))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (got := _gathered(batches, [np.uint64, np.int64, np.int64])) is None:
            return
        h, item, size = (c[np.lexsort((got[1], got[0]))] for c in got)
        new = np.append(True, (h[1:] != h[:-1]) | (item[1:] != item[:-1]))  # a repeated row shows its shingles again
        h, item, size = h[new], item[new], size[new]
        _, back, seen = np.unique(h, return_inverse=True, return_counts=True)
        seen = seen[back]
        use = seen > 1
        yield _dealt(parts, item[use].view(np.uint64), h[use], item[use], size[use], seen[use])

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (got := _gathered(batches, [np.uint64, np.int64, np.int64, np.int64])) is None:
            return
        h, item, size, _ = (c[np.lexsort((got[0], got[3], got[1]))] for c in got)
        _, begin, count = np.unique(item, return_index=True, return_counts=True)
        own = np.repeat(size[begin] - count, count)  # shingles of no other item come first
        can, most = _reach(size, own + np.arange(len(item)) - np.repeat(begin, count), similarity)
        yield _dealt(parts, h[can], h[can], item[can], size[can], most[can])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (got := _gathered(batches, [np.uint64, np.int64, np.int64, np.int64])) is None:
            return
        h, item, size, most = (c[np.argsort(got[0], kind="stable")] for c in got)
        nodes, node = np.unique(item, return_inverse=True)
        begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        runs = zip(begin.tolist(), [*begin[1:].tolist(), len(h)], strict=True)
        pairs = (p for i, j in runs if j - i > 1 for p in _met(node[i:j], size[i:j], most[i:j]))
        least = least_labels(len(nodes), pairs, nodes)
        far = least != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(least[far])], ["u", "v"])

    return spelled, counted, ordered, linked


def _met(node: np.ndarray, size: np.ndarray, most: np.ndarray, classes: int = 2000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the nodes that can be similar, neither larger than the other allows; as many as there are nodes and classes of them, not pairs of nodes."""
    step = 1
    while True:  # coarser classes allow more and lose no pair
        kind, first, back, n = np.unique(np.stack([size // step * step, -(-most // step) * step], axis=1), axis=0, return_index=True, return_inverse=True, return_counts=True)
        if len(kind) <= classes:
            break
        step *= 2
    back, low, high, joined = back.reshape(-1), kind[:, 0], kind[:, 1], np.zeros(len(kind), bool)
    for c in range(len(kind)):
        fit = (low <= high[c]) & (low[c] <= high)
        fit[c] &= n[c] > 1
        joined |= fit
        if fit.any():
            yield np.full(fit.sum(), node[first[c]]), node[first[fit]]
    rows = joined[back]
    yield node[rows], node[first[back[rows]]]


def deduplicated(docs: DataFrame, words: int = 5, similarity: float = 0.8, prints: int = 12, radius: int = 14, second: int = 20, shard_rows: int = SHARD_ROWS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """docs without exact and near copies: of each group the row with the smallest doc_id stays, all columns kept.

    Copies of a text go first, by digest. Each text left has ``prints`` SimHash
    fingerprints of its distinct shingles; texts that agree on a 16-bit band of
    one, differ in at most radius bits of it (found by the band's BK-tree) and
    in at most second bits of the next are candidates. The texts of a component of
    candidates meet in one task, a unit, which finds all pairs of an exact Jaccard
    similarity of ``similarity`` or more (see ``alike``) and tells of each text only
    the first of its group. Components of over unit_rows texts are taken apart
    before: the prefix filter that finds similar pairs in a unit deals their shingles
    out to tasks, rarest first, and what it leaves connected is a unit. Units that
    are still too large are cut into blocks of unit_rows / 2, each two of which are
    one. Neither loses a similar pair, and no step gives out pairs.

    At similarity 0.8 a pair is a candidate with a chance of about 0.96, at 0.85 of over 0.99.
    Null texts count as copies of each other, null doc_ids come last, repeated rows
    are copies, and an empty table gives an empty result. docs is read several times,
    and tables that grow with it meet its texts by a shuffle at every size.
    """
    columns = lean(docs).columns
    digest, name = unique_name(docs, "digest"), unique_name(docs, "item")
    named = docs.withColumn(digest, F.md5("text"))
    kinds = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("digest", T.StringType()), T.StructField("prints", T.ArrayType(T.LongType()))])
    copies = named.select("doc_id", digest, "text").mapInArrow(_sketches(words, prints), kinds).groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.first("prints").alias("prints"))
    least = copies.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "n")).alias("r"), F.first("prints").alias("prints"))
    unique = saved(least.select(F.xxhash64("r.doc_id", "digest").alias("item"), "r.doc_id", "r.n", "prints"))
    named = named.withColumn(name, F.xxhash64("doc_id", digest))
    texts = named.select(F.col(name).alias("item"), "doc_id", "text")

    band = lambda p, b: F.struct(F.xxhash64(F.lit(p), F.lit(b), F.shiftrightunsigned(F.col("prints")[p], 16 * b).bitwiseAND(F.lit(0xFFFF))).alias("key"), F.col("prints")[p].alias("fp"), F.col("prints")[(p + 1) % prints].alias("fp2"))
    banded = unique.select("item", F.explode(F.array(*[band(p, b) for p in range(prints) for b in range(4)])).alias("b")).select("item", "b.fp", "b.fp2", "b.key")
    parts = max(spread(docs), unique.count() * 4 * prints // TASK_ROWS)
    found = links(_blocked(banded, _large(banded, shard_rows)), radius, parts, second)
    units = saved(components(found).select(F.col("node").alias("item"), F.col("component").alias("key")))
    parts = max(spread(docs), units.count() // TASK_TEXTS)
    whole, crowds = _split(units, unit_rows)
    units = whole.withColumn("cut", F.lit(False))
    if crowds is not None:
        spelled, counted, ordered, linked = _meeting(words, similarity, parts)
        dealt = texts.join(saved(crowds.select("item")), "item").select("item", "text").mapInArrow(spelled, _DEALT)
        for step in (counted, ordered):
            dealt = dealt.repartition(parts, "bucket").mapInArrow(step, _DEALT)
        met = saved(components(dealt.repartition(parts, "bucket").mapInArrow(linked, "u long, v long")).select(F.col("node").alias("item"), F.col("component").alias("key")))
        whole, crowds = _split(met, unit_rows)
        units = units.union(whole.withColumn("cut", F.lit(False)))
        if crowds is not None:
            units = units.union(_blocked(crowds, _large(crowds, max(1, unit_rows // 2))).withColumn("cut", F.lit(True)))
    rows = texts.join(units.hint("shuffle_hash"), "item").select(F.col("key").alias("unit"), "cut", "item", "doc_id", "text").repartition(parts, "unit").sortWithinPartitions("unit", "cut")
    edges = saved(rows.mapInArrow(_grouped(words, similarity), "u long, v long, cut boolean"))
    gone = edges.where("not cut").select(F.col("u").alias("item"))
    if crowds is not None:
        groups = components(edges.where("cut").select("u", "v")).withColumnRenamed("node", "item").join(unique.select("item", "doc_id"), "item")
        first = groups.groupBy("component").agg(F.min_by("item", F.struct(F.col("doc_id").isNull(), "doc_id", "item")).alias("lead"))
        gone = gone.union(groups.join(first, "component").where("item <> lead").select("item"))
    kept = saved(unique.join(gone, "item", "left_anti").select(F.col("item").alias(name), "n"))
    out = named.join(kept.where("n = 1").hint("shuffle_hash"), name, "left_semi")
    repeated = kept.where("n > 1")
    if not repeated.isEmpty():
        out = out.union(named.join(repeated, name, "left_semi").dropDuplicates([name]).select(*out.columns))
    return out.select(*columns)


def _split(units: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """units (item, key) of at most that many rows a key, and the others; None if there are none."""
    big = _large(units, most)
    return (units, None) if big is None else (units.join(big, "key", "left_anti").select("item", "key"), units.join(big, "key", "left_semi").select("item", "key"))
