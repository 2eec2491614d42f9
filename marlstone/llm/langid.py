"""Language identification of code-switched text with a linear-chain conditional random field.

Words are runs of letters, lower-cased. A word's features are its affixes (two
and three letters at either end), the letter bigrams and trigrams in it, and the
word itself (the learned lexicon), each hashed to a row of one weight table;
transitions between the languages of neighbouring words are learned with them.
Training sequences splice stretches of labelled documents of different
languages, so that the transitions have seen switches. Forward-backward gives
each word its posterior, and a document takes the language with the largest sum.

A posterior only says which of the learned languages fits best. Whether any does
is told by the share of a text's letter trigrams that the fitted samples held:
texts of these languages, mixed or not, hold hardly any other, and gibberish, other
scripts and unknown languages hold many. The share below which a text is rejected
is calibrated on the samples.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marlstone.llm.common import lean, sliced

UNDETERMINED = "und"
BITS = 17
BLOCK = 64
#: A text is rejected below this part of the least share of known trigrams among the samples (their lowest hundredth aside); its own share counts so many known ones more, since few letters tell little.
LEAST_PART, GRACE = 0.7, 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Words:
    """Features of the words of several texts: table rows per letter and per word, and where words and texts begin."""

    grams: list[np.ndarray]
    begin: np.ndarray
    whole: list[np.ndarray]
    per_text: np.ndarray

    @property
    def n(self) -> int:
        return len(self.begin)


def featurize(texts: list[str | None]) -> Words:
    joined = "\n".join((t or "").replace("\n", " ") for t in texts).lower() + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    breaks = np.flatnonzero(cp == 10)
    if len(breaks) != len(texts):  # lower() never makes a newline, but a text may hold other line ends kept as they are
        raise ValueError("texts were not told apart")
    letter = _letters()[cp]
    at = np.flatnonzero(letter)
    pad = np.concatenate([[0, 0], np.where(letter, cp, 0), [0, 0]]).astype(np.uint64)
    here, after, before = pad[at + 2], pad[at + 3], pad[at + 1]
    shift = np.uint64(21)
    bigram = (here << shift) | after
    trigram = (before << np.uint64(42)) | bigram
    first = pad[at + 1] == 0
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(at)) - 1
    second = np.where(begin < end, here[np.minimum(begin + 1, end)], 0)
    third = np.where(begin + 1 < end, here[np.minimum(begin + 2, end)], 0)
    last, but1 = here[end], np.where(begin < end, here[np.maximum(end - 1, begin)], 0)
    but2 = np.where(begin + 1 < end, here[np.maximum(end - 2, begin)], 0)
    word = np.zeros(len(begin), np.uint64)
    if len(begin):
        place = (np.arange(len(at)) - np.repeat(begin, end - begin + 1)).astype(np.uint64)
        spread = (here * np.uint64(0x100000001B3) + place * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xFF51AFD7ED558CCD)
        spread = (spread ^ (spread >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        word = np.add.reduceat(spread, begin)
    two, three = lambda a, b: (a << shift) | b, lambda a, b, c: (a << np.uint64(42)) | (b << shift) | c
    whole = [_mix(two(here[begin], second), 3), _mix(three(here[begin], second, third), 4), _mix(two(but1, last), 5), _mix(three(but2, but1, last), 6), _mix(word, 7)]
    per_text = np.bincount(np.searchsorted(breaks, at[begin]), minlength=len(texts)) if len(begin) else np.zeros(len(texts), np.int64)
    return Words([_mix(bigram, 1), _mix(trigram, 2)], begin, whole, per_text)


def scores(w: Words, table: np.ndarray) -> np.ndarray:
    """Emission scores [word, language]."""
    if not w.n:
        return np.zeros((0, table.shape[1]), np.float32)
    out = np.add.reduceat(table[w.grams[0]] + table[w.grams[1]], w.begin, axis=0)
    for f in w.whole:
        out += table[f]
    return out


def posteriors(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Marginals [word, label] of linear chains laid end to end (lengths), by forward-backward.

    Chains are cut into blocks whose transfer matrices are multiplied in a scan, so
    that long and short chains advance together; the result is that of the plain recursion.
    """
    n, k = emit.shape
    if not n:
        return emit
    e_flat = np.exp(emit - emit.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    a = np.exp(moves - moves.max()).astype(np.float64)
    blocks = -(-lengths // block)
    nb = int(blocks.sum())
    chain = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(nb) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    word_start = np.cumsum(lengths) - lengths
    at = (word_start[chain] + nth * block)[:, None] + np.arange(block)
    live = at < (word_start + lengths)[chain][:, None]
    e = e_flat[np.minimum(at, n - 1)]
    start = nth == 0
    m = np.broadcast_to(np.eye(k), (nb, k, k)).copy()
    for t in range(block):
        step = (m.reshape(-1, k) @ a).reshape(nb, k, k)
        if t == 0:
            step[start] = m[start]
        step *= e[:, t, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        m = np.where(live[:, t, None, None], step, m)
    into, out = np.empty((nb, k)), np.empty((nb, k))
    first, last = np.cumsum(blocks) - blocks, np.cumsum(blocks) - 1
    have = np.flatnonzero(blocks)
    now = np.full((len(have), k), 1.0 / k)
    for j in range(int(blocks.max())):
        keep = blocks[have] > j
        have, now = have[keep], now[keep]
        b = first[have] + j
        into[b] = now
        now = np.einsum("ni,nij->nj", now, m[b])
        now /= now.sum(axis=1, keepdims=True)
    have = np.flatnonzero(blocks)
    now = np.ones((len(have), k))
    for j in range(int(blocks.max())):
        keep = blocks[have] > j
        have, now = have[keep], now[keep]
        b = last[have] - j
        out[b] = now
        now = np.einsum("nij,nj->ni", m[b], now)
        now /= now.sum(axis=1, keepdims=True)
    forward, now = np.empty((nb, block, k)), into
    for t in range(block):
        step = now @ a
        if t == 0:
            step[start] = now[start]
        step = step * e[:, t]
        step /= step.sum(axis=1, keepdims=True)
        now = np.where(live[:, t, None], step, now)
        forward[:, t] = now
    now = out
    for t in range(block - 1, -1, -1):
        forward[:, t] *= now
        step = (now * e[:, t]) @ a.T
        step /= step.sum(axis=1, keepdims=True)
        now = np.where(live[:, t, None], step, now)
    gamma = forward[live]
    return gamma / gamma.sum(axis=1, keepdims=True)


def _share(w: Words, known: np.ndarray) -> np.ndarray:
    """Of each text's letter trigrams the share known, GRACE known ones added."""
    of_word = np.repeat(np.arange(len(w.per_text)), w.per_text)
    letters = np.diff(np.append(w.begin, len(w.grams[1])))
    n = np.bincount(of_word, letters, len(w.per_text))
    hits = np.bincount(of_word, np.add.reduceat(known[w.grams[1]].astype(np.int64), w.begin), len(w.per_text)) if w.n else np.zeros(len(w.per_text))
    return (hits + GRACE) / (n + GRACE)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    moves: np.ndarray
    known: np.ndarray
    least: float = 0.0

    @staticmethod
    def fit(samples: list[tuple[str, str]], epochs: int = 3, length: int = 96, seed: int = 5, rate: float = 0.2) -> Model:
        """samples: (text, language). Conditional likelihood of spliced sequences, climbed by AdaGrad."""
        languages = sorted({s[1] for s in samples})
        k = len(languages)
        table, moves = np.zeros((1 << BITS, k), np.float32), np.zeros((k, k))
        known = np.zeros(1 << BITS, bool)
        lots = [samples[i : i + 100] for i in range(0, len(samples), 100)]
        for lot in lots:
            known[featurize([s[0] for s in lot]).grams[1]] = True
        if k < 2:
            return Model(languages, table, moves, known).calibrated(lots)
        rng = np.random.default_rng(seed)
        seen, seen_moves = np.full((1 << BITS, k), 1e-2, np.float32), np.full((k, k), 1e-2)
        pieces: list[tuple[str, int]] = []
        for text, language in samples:
            words, lo = text.split(), 0
            while lo < len(words):
                n = int(rng.integers(8, 60))
                pieces.append((" ".join(words[lo : lo + n]), languages.index(language)))
                lo += n
        for _ in range(epochs):
            order = rng.permutation(len(pieces))
            for lo in range(0, len(order), 256):
                part = [pieces[i] for i in order[lo : lo + 256]]
                w = featurize([p[0] for p in part])
                if not w.n:
                    continue
                gold = np.repeat([p[1] for p in part], w.per_text)
                lengths = np.full(-(-w.n // length), length)
                lengths[-1] = w.n - length * (len(lengths) - 1)
                emit = scores(w, table)
                gamma = posteriors(emit, lengths, moves)
                slope = -gamma
                slope[np.arange(w.n), gold] += 1
                pull = np.zeros_like(table)
                per_letter = np.repeat(slope, np.diff(np.append(w.begin, len(w.grams[0]))), axis=0).astype(np.float32)
                for rows, g in [*((x, per_letter) for x in w.grams), *((x, slope) for x in w.whole)]:
                    for c in range(k):
                        pull[:, c] += np.bincount(rows, g[:, c], 1 << BITS).astype(np.float32)
                pull /= len(lengths)
                seen += pull**2
                table += (rate * pull / np.sqrt(seen)).astype(np.float32)
                inner = np.ones(w.n - 1, bool)
                inner[np.cumsum(lengths)[:-1] - 1] = False
                left, right = gamma[:-1][inner], gamma[1:][inner]
                pair = left[:, :, None] * np.exp(moves - moves.max()) * right[:, None, :]
                pair /= pair.sum(axis=(1, 2), keepdims=True)
                real = np.zeros((k, k))
                np.add.at(real, (gold[:-1][inner], gold[1:][inner]), 1)
                pull_moves = (real - pair.sum(axis=0)) / len(lengths)
                seen_moves += pull_moves**2
                moves += rate * pull_moves / np.sqrt(seen_moves)
        return Model(languages, table, moves, known).calibrated(lots)

    def calibrated(self, lots: list[list[tuple[str, str]]]) -> Model:
        """With the least share of trigrams known from the other half of the samples that texts of these languages have."""
        halves, shares = [np.zeros(1 << BITS, bool), np.zeros(1 << BITS, bool)], []
        for part, held in ((0, halves[0]), (1, halves[1])):
            for lot in lots:
                held[featurize([s[0] for s in lot[part::2]]).grams[1]] = True
        for part in (0, 1):
            for lot in lots:
                w = featurize([s[0] for s in lot[part::2]])
                shares.append(_share(w, halves[1 - part])[w.per_text > 0])
        found = np.concatenate(shares) if shares else np.zeros(0)
        self.least = LEAST_PART * float(np.quantile(found, 0.01)) if len(found) else 0.0
        return self

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        return [said[:2] for said in self.judge(texts)]

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, share of known trigrams) of each text."""
        w = featurize(texts)
        if not self.languages:
            return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
        share_known = _share(w, self.known)
        gamma = posteriors(scores(w, self.table), w.per_text, self.moves)
        text = np.repeat(np.arange(len(texts)), w.per_text)
        mass = np.stack([np.bincount(text, gamma[:, c], len(texts)) for c in range(len(self.languages))], axis=1)
        best = mass.argmax(axis=1)
        share = mass[np.arange(len(texts)), best] / np.maximum(w.per_text, 1)
        return [(self.languages[b], float(min(1.0, s)), float(h)) if n else (UNDETERMINED, 0.0, 0.0) for b, s, h, n in zip(best, share, share_known, w.per_text, strict=True)]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the doc_id as text is divisible by 5; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_language: int = 400, stretch: int = 4000) -> Model:
    """A model from at most per_language stretches of that many characters of each language, drawn evenly from all of its labelled documents that are not held out, whole texts.

    Both bounds concern fitting alone. Null languages, ids and texts are left out.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "doc_id", "text", F.greatest(F.ceil(F.length("text") / stretch), F.lit(1)).cast("long").alias("n"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row per language
    if not counts:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)), np.zeros(1 << BITS, bool))
    limit = F.lit(0)
    for lang, n in counts.items():
        limit = F.when(F.col("lang") == lang, int(min(1.0, (per_language * 1.1 + 20) / n) * (1 << 30))).otherwise(limit)
    cut = known.select("lang", "doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    drawn = cut.withColumn("draw", F.pmod(F.xxhash64("doc_id", "i"), F.lit(1 << 30))).where(F.col("draw") < limit)
    rows = drawn.select("lang", F.expr(f"substring(text, cast(i * {stretch} + 1 as int), {stretch})").alias("text"), "draw", "doc_id", "i").collect()
    by: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["draw"], r["doc_id"], r["i"], r["text"])):
        by.setdefault(r["lang"], []).append((r["text"], r["lang"]))
    return Model.fit([s for lang in sorted(by) for s in by[lang][:per_language]])


ADDED = ("lang_pred", "score", "known")


def identify(docs: DataFrame, model: Model, chars_at_once: int = 200_000) -> DataFrame:
    """docs with lang_pred, score and known added (columns of these names are replaced).

    lang_pred is und, with score 0, for a null text and one without a letter;
    score is else the language's share of the words' posteriors. known: the share
    of the text's trigrams that the model has seen; below model.least the text is
    in none of its languages. Repeated rows are all kept, and an empty table gives
    an empty result.
    """
    docs = lean(docs.drop(*ADDED))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = b.column(at).to_pylist()
            said, part, size = [], [], 0
            for t in texts:
                part.append(t)
                size += len(t or "")
                if size >= chars_at_once:
                    said += model.judge(part)
                    part, size = [], 0
            said += model.judge(part) if part else []
            more = [pa.array(c, t) for c, t in zip(zip(*said, strict=True), (pa.string(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *ADDED])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("known", DoubleType())])
    return docs.mapInArrow(run, schema)
