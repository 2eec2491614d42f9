"""Benchmark decontamination: passages within a word edit distance of a benchmark item.

The CGK random walk (Chakraborty, Goldenberg, Koucky 2016) embeds word sequences
so that edit distance becomes Hamming distance. Item-sized windows of every
document are embedded, a few sampled symbols of the embedding form a hash key,
and repetitions with fresh walks and samples bring a window within the radius to
a key it shares with its item, at its start, middle or end. How many repetitions
a length takes is measured: its items are edited as much as the radius allows, and
repetitions are added until the share ``recall`` of these copies meets its item.
Each candidate is then confirmed by the exact edit distance of the item to the
best stretch of the document nearby.

Two exact conditions spare windows the walk and lose no match: of the words of a
match at most k are in no item, and, k edits leaving k+1 blocks of which one is
whole, a match holds some run of ``block`` words of an item.

Items go to the executors in parts of at most ITEMS_AT_ONCE, one pass a part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import lean, saved, sliced

ITEMS_AT_ONCE = 20_000
#: Words of the widest window: beyond, walks of edited texts part for good before they end.
WIDEST = 48
_PUNCT = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_GRAMS = 1 << 22
SCHEMA = "doc_id long, item_id long, distance int, item_words int, at_word long"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates them."""
    return (text or "").lower().encode().translate(_PUNCT).split()


def window_of(n: int, widest: int = WIDEST) -> tuple[int, int]:
    """Window words and stride for an item of n words: about four fifths of it, in steps of an eighth, so that several windows of a stride lie in every occurrence; of a long item widest words, at all places along it."""
    w = 1
    while w + max(1, w // 8) <= min(n - n // 5, widest):
        w += max(1, w // 8)
    return w, max(1, w // 8)


def edited(codes: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """codes with that many words replaced, left out or put in, at random places."""
    out = codes.tolist()
    for kind in rng.integers(0, 3, edits).tolist():
        at = int(rng.integers(0, max(1, len(out))))
        if kind == 2 or not out:
            out.insert(at, 0)
        elif kind == 1:
            del out[at]
        else:
            out[at] = 0
    return np.array(out, np.int64)


def infix_distance(item: list[int], text: list[int], most: int) -> tuple[int, int]:
    """Least edit distance of item to any stretch of text, and where the first such stretch ends; Myers' bit vectors."""
    m, eq = len(item), {}
    for i, w in enumerate(item):
        eq[w] = eq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text):
        e = eq.get(w, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, j + 1
            if best == 0:
                break
    return best, end


class Index:
    """Items by hash key; built on the driver from a bounded part, used on the executors."""

    def __init__(self, items: list[tuple[int, str | None]], ratio: float, recall: float, samples: int, seed: int = 7):
        self.vocab: dict[bytes, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        for item_id, text in items:
            codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            if codes and item_id is not None:
                self.items.append((item_id, codes))
        self.most = [int(ratio * len(c)) for _, c in self.items]
        rng = np.random.default_rng(seed)
        self.classes: list[dict] = []
        by_window: dict[tuple[int, int, int], list[int]] = {}
        for i, (_, c) in enumerate(self.items):
            w, s = window_of(len(c))
            by_window.setdefault((w, s, min(4, len(c) // (self.most[i] + 1))), []).append(i)
        self.pad = max([0, *(2 * len(c) for _, c in self.items)]) + 8
        for (w, s, block), members in sorted(by_window.items()):
            cls = {"w": w, "s": s, "block": block, "k": max(self.most[i] for i in members), "reach": max(len(self.items[i][1]) for i in members)}
            codes = [np.array(self.items[i][1], np.int64) for i in members]
            grams = np.zeros(_GRAMS, bool)
            for c in codes:
                grams[_runs(c, block)] = True
            cls["grams"] = np.packbits(grams)
            self._repeat(cls, codes, [self.most[i] for i in members], recall, samples, rng)
            offsets = [np.arange(len(c) - w + 1) for c in codes]
            begin = np.cumsum([0] + [len(c) for c in codes])[:-1]
            starts = np.concatenate([x + o for x, o in zip(begin, offsets, strict=True)])
            owner, offset = np.repeat(np.array(members), [len(o) for o in offsets]), np.concatenate(offsets)
            keys = self._keys(cls, np.append(np.concatenate(codes), np.zeros(self.pad, np.int64)), starts)
            cls["tables"] = []
            for r in range(keys.shape[0]):
                by = np.argsort(keys[r], kind="stable")
                cls["tables"].append((keys[r][by], owner[by], offset[by]))
            self.classes.append(cls)

    def _repeat(self, cls: dict, codes: list[np.ndarray], most: list[int], recall: float, samples: int, rng: np.random.Generator, trials: int = 150, rounds: int = 8) -> None:
        """Draws the walks and samples of a class: as many repetitions as bring the share recall of items, edited to the limit, to their item's key."""
        w, s = cls["w"], cls["s"]
        picks = [int(x) for x in rng.integers(0, len(codes), trials)]
        copies = [edited(codes[i], most[i], rng) for i in picks]
        phase = [int(rng.integers(0, s)) for _ in picks]
        # all copies and all originals laid end to end, with the windows that lie in each
        at = [np.arange(shift, len(c) - w + 1, s) for c, shift in zip(copies, phase, strict=True)]
        own = [np.arange(len(codes[i]) - w + 1) for i in picks]
        lay = lambda texts, windows: (np.append(np.concatenate(texts), np.zeros(w, np.int64)), np.concatenate([b + x for b, x in zip(np.cumsum([0] + [len(t) for t in texts])[:-1], windows, strict=True)]))
        theirs, ours = lay(copies, at), lay([codes[i] for i in picks], own)
        ends = [np.cumsum([0] + [len(x) for x in windows]).tolist() for windows in (at, own)]
        met, drawn = np.zeros(trials, bool), []
        for _ in range(rounds):
            part = {"w": w, "flips": rng.integers(0, 2, (8, 3 * w, 1 << 10), dtype=np.uint8)}
            steps = max(2 * w, 1)
            part["at"] = np.sort(np.stack([rng.permutation(steps)[:samples] for _ in range(8)]), axis=1) if steps >= samples else np.tile(np.arange(steps), (8, 1))
            part["mix"] = rng.integers(1, 1 << 62, part["at"].shape, dtype=np.int64) | 1
            left, right = self._keys(part, *theirs), self._keys(part, *ours)
            hits = np.array([[np.isin(a, b).any() for a, b in zip(left[:, ends[0][t] : ends[0][t + 1]], right[:, ends[1][t] : ends[1][t + 1]], strict=True)] for t in range(trials)])
            sums = (met[:, None] | np.logical_or.accumulate(hits, axis=1)).mean(axis=0)
            enough = np.flatnonzero(sums >= recall)
            take = int(enough[0]) + 1 if len(enough) else 8
            drawn.append({k: part[k][:take] for k in ("flips", "at", "mix")})
            met |= hits[:, :take].any(axis=1)
            if len(enough):
                break
        for k in ("flips", "at", "mix"):
            cls[k] = np.concatenate([d[k] for d in drawn])
        cls["recall"] = float(met.mean())

    @staticmethod
    def _keys(cls: dict, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys [repeat, window]: sampled symbols of the walk over each window, mixed."""
        w, flips, at, mix = cls["w"], cls["flips"], cls["at"], cls["mix"]
        keys = np.zeros((len(flips), len(starts)), np.int64)
        for r in range(len(flips)):
            where, want, end = starts.copy(), dict(zip(at[r].tolist(), mix[r].tolist(), strict=True)), starts + w
            for j in range(max(want) + 1):
                inside = where < end
                c = np.where(inside, codes[np.minimum(where, end - 1)], -1)
                if j in want:
                    keys[r] = (keys[r] ^ (c + 2)) * np.int64(want[j])
                    keys[r] ^= (keys[r] >> 29) & 0x7FFFFFFFF
                where += np.where(inside, flips[r, j][c & 1023], 0)
        return keys

    def candidates(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, start of the item in codes) of windows that share a key with an item."""
        missing = np.concatenate([[0], np.cumsum(codes == 0)])
        for cls in self.classes:
            w, s, k, block = cls["w"], cls["s"], cls["k"], cls["block"]
            starts = np.arange(0, max(0, len(codes) - w), s)
            starts = starts[missing[starts + w] - missing[starts] <= k]
            gram = _runs(codes, block)
            seen = np.concatenate([[0], np.cumsum((cls["grams"][gram >> 3] >> (7 - (gram & 7))) & 1)])
            low = np.minimum(np.maximum(starts - s - k, 0), len(gram))
            starts = starts[seen[np.minimum(starts + cls["reach"] + k, len(gram))] > seen[low]]
            for c in range(0, len(starts), 20_000):
                part = starts[c : c + 20_000]
                keys = self._keys(cls, codes, part)
                for r, (sorted_keys, owner, offset) in enumerate(cls["tables"]):
                    lo, hi = np.searchsorted(sorted_keys, keys[r], "left"), np.searchsorted(sorted_keys, keys[r], "right")
                    n = hi - lo
                    if n.any():
                        pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        yield owner[pick], np.repeat(part, n) - offset[pick]

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item_id, distance, item words, first word) of the best match of each item in each text."""
        parts, begin, at, gap = [], [], self.pad, np.zeros(self.pad, np.int64)
        get = self.vocab.get
        parts.append(gap)
        for t in texts:
            c = np.array([get(w, 0) for w in words_of(t)], np.int64)
            begin.append(at)
            parts += [c, gap]
            at += len(c) + self.pad
        codes, begin = np.concatenate(parts), np.array(begin)
        found = list(self.candidates(codes))
        if not found:
            return
        item, start = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        both = np.unique(np.stack([item, start]), axis=1)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        last = (-1, -1)
        for i, p in both.T.tolist():
            n, k = len(self.items[i][1]), self.most[i]
            if last[0] == i and p - last[1] <= k // 2:
                continue
            last = (i, p)
            low = max(0, p - 2 * k)
            d, end = infix_distance(self.items[i][1], codes[low : p + n + 2 * k + 1].tolist(), k)
            if d <= k:
                doc = int(np.searchsorted(begin, low + end, "right")) - 1
                hit = (d, max(0, low + end - n - int(begin[doc])))
                if hit < best.get((doc, i), (1 << 30, 0)):
                    best[doc, i] = hit
        for (doc, i), (d, at_word) in best.items():
            yield doc, self.items[i][0], d, len(self.items[i][1]), at_word


def _runs(codes: np.ndarray, block: int) -> np.ndarray:
    """Hash of each run of block codes."""
    n = max(0, len(codes) - block + 1)
    h = np.zeros(n, np.int64)
    for j in range(block):
        h = (h * 1_000_003 + codes[j : j + n]) & ((1 << 40) - 1)
    return (h ^ (h >> 18)) & (_GRAMS - 1)


def _portions(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about that many characters at most, or of one longer text."""
    for b in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if texts and size + len(t or "") > chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or "")
        yield ids, texts


def find_leaks(docs: DataFrame, benchmark: DataFrame, ratio: float = 0.2, recall: float = 0.97, samples: int = 4, items_at_once: int = ITEMS_AT_ONCE, chars_at_once: int = 500_000) -> DataFrame:
    """(doc_id, item_id, distance, item_words, at_word): the best match of each item in each document, within ratio edits a word.

    recall: the share of matches edited to the limit of ratio that are found; of
    less edited ones more are, of unedited ones all.

    Words are lower-cased and free of ASCII punctuation. Null or empty texts and
    items match nothing, repeated documents are reported each for itself,
    repeated item rows once per row, and extra columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n_parts = max(1, -(-items.count() // items_at_once))
    source = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for part in range(n_parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == part).collect()  # about items_at_once rows
        index = Index(sorted((tuple(r) for r in rows), key=str), ratio, recall, samples)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for ids, texts in _portions(sliced(batches, 1000), chars_at_once):
                hits = [(ids[d], *rest) for d, *rest in index.matches(texts)] if index.classes else []
                cols = list(zip(*hits, strict=True)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "distance", "item_words", "at_word"])

        found = source.mapInArrow(run, SCHEMA)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without those that hold a benchmark item; rows with a null doc_id stay.

    The leaks are written first: while they are few, which their table tells, no text is shuffled to meet them.
    """
    leaks = saved(find_leaks(docs, benchmark, **how).select("doc_id").distinct())
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
