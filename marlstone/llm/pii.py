"""Personal data by patterns and a skip-chain conditional random field.

Four patterns give the base spans, which always stay. The field then labels the
tokens that hold a digit, @ or + or a written-out at sign, or equal the name part
of an address in the same document; every other token is observed as outside.
Neighbouring tokens share chain potentials, and repeated or similar tokens (equal
letters and digits, equal digits, an address and its name part) share skip
potentials, each with the next of its group, so that a group of m tokens has m-1
links.

Weights are fitted by pseudolikelihood on base labels of a bounded sample, and on
the same sample once more with its base spans hidden: rewritten so that no
pattern finds them (a phone number without +, a card number in groups of other
signs, an address with its signs written out), while their labels stay, among
dates, versions, prices and other numbers that nobody's data are. Tokens of a match
that failed because it ran into the next number (too many digits) have no
label while fitting; one that failed its checksum is an example of outside.

Marginals come from loopy belief propagation over a batch of documents at once,
until the messages settle. Base labels are observed there, and each unlabelled
token that repeats a labelled one (six letters and digits or more, a digit among
them, or six equal digits) has a link of its own to it, so that a label reaches
all repeats at any distance. Tokens that the field is sure of and no base span
touches become further spans.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marlstone.llm.common import lean, sliced, unique_name

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"\S+")
SIGN = re.compile(r"[0-9@+]|[(\[]at[)\]]", re.IGNORECASE)
DIGIT = re.compile("[0-9]")
ROWS = 1 << 14
#: Prior of the skip potentials: what repeated tokens gain by equal labels while the sample doesn't say otherwise.
AGREE = 2.5
#: The same for a link to a token that a base span labels, which is known and not inferred.
REPEATS = 10.0
K = len(KINDS) + 1
EDGES = "\"'()[]{}<>.,;:!?"
#: Gold label of a token that fitting leaves open.
OPEN = -1
#: Least belief in a label for a further span.
SURE = 0.9


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in found.split(".")))
    n, digits = 0, []
    for m in DIGIT.finditer(found):
        digits.append(m[0])
        n += 1
        if n > 19:
            return False
    return 13 <= n <= 19 and luhn("".join(digits)) if kind == "card" else 9 <= n <= 15


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """What the email pattern finds from the left, each character looked at a bounded number of times: a match ends its name part at an @."""
    free = 0
    for m in re.finditer("@", text):
        at = m.start()
        if at < free:
            continue
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1


def _quads(text: str) -> Iterator[tuple[int, int]]:
    """What the ip pattern finds from the left: groups of digits with dots between, four at a time."""
    for m in DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            yield at, at + size
            at += size + 1


def patterns(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans (kind number, start, end), and matches that fail their kind's test, both by kind and start."""
    good, bad = [], []
    digits = DIGIT.search(text) is not None
    spans = [
        _addresses(text) if "@" in text else (),
        _quads(text) if digits else (),
        (m.span() for m in CARD.finditer(text)) if digits else (),
        (m.span() for m in PHONE.finditer(text)) if digits and "+" in text else (),
    ]
    for k, (kind, found) in enumerate(zip(KINDS, spans, strict=True)):
        for s, e in found:
            (good if _holds(kind, text[s:e]) else bad).append((k, s, e))
    return good, bad


def _shape(token: str) -> str:
    out = []
    for run in itertools.islice(re.finditer(r"[0-9]+|[^\W\d_]+|.", token, re.DOTALL), 24):
        out.append(f"d{min(len(run[0]), 20)}" if run[0][0] in "0123456789" else "a" if run[0][0].isalpha() else run[0][:1])
    return "".join(out)


def _row(*parts: object) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode()) % ROWS


@dataclass
class Graph:
    """Active tokens of several texts: spans, weak labels, feature rows, chain and skip edges, sides open to observed words, and links from labelled tokens to their unlabelled repeats."""

    text: list[int]
    start: list[int]
    end: list[int]
    gold: list[int]
    rows: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    known: list[tuple[int, int]] = field(default_factory=list)


def _touching(marks: list[tuple[int, int, int]], s: int, e: int, at: int) -> tuple[int, int, str]:
    """(first mark that doesn't end before s, gold kind+1 or 0, how a match there failed) of one kind's marks, in order and apart: (start, end, kind or -1-digits)."""
    while at < len(marks) and marks[at][1] <= s:
        at += 1
    gold, failed, i = 0, "", at
    while i < len(marks) and marks[i][0] < e and not gold:
        gold, failed = (marks[i][2] + 1, "") if marks[i][2] >= 0 else (0, "many" if marks[i][2] < -20 else "few" if marks[i][2] > -10 else "test")
        i += 1
    return at, gold, failed


def _tests(token: str, digits: str) -> str:
    """Which checks the token passes alone: checksum, octets."""
    if 13 <= len(digits) <= 19:
        return f"luhn {luhn(digits)}"
    parts = re.split(r"\D+", token.strip(EDGES))
    return f"octets {all(len(p) <= 3 and int(p) <= 255 for p in parts)}" if len(parts) == 4 and all(parts) else ""


def build(texts: list[str], found: list[tuple[list, list]], told: list[list[tuple[int, int, int]]] | None = None) -> Graph:
    """The graph of texts with their matches (patterns()). told: for each text its true spans, in place of those that patterns found."""
    g = Graph([], [], [], [], [], [], [])
    for n, (text, (good, bad)) in enumerate(zip(texts, found, strict=True)):
        if not (good or bad) and not SIGN.search(text):
            continue
        words = [m.span() for m in WORD.finditer(text)]
        names = {text[s:e].split("@")[0].lower() for k, s, e in good if k == 0}
        active = [i for i, (s, e) in enumerate(words) if SIGN.search(text, s, e) or (names and text[s:e].strip(EDGES).lower() in names)]
        tokens = [words[i] for i in active]
        first = len(g.text)
        shapes = [_shape(text[s:e]) for s, e in tokens]
        marks: list[list[tuple[int, int, int]]] = [[] for _ in KINDS]
        for k, s, e in good:
            marks[k].append((s, e, k))
        for k, s, e in bad:
            marks[k].append((s, e, -1 - min(40, sum(1 for _ in itertools.islice(DIGIT.finditer(text, s, e), 40)))))
        marks = [sorted(m) for m in marks]
        true = sorted((s, e, k) for k, s, e in told[n]) if told else []
        groups: dict[tuple[str, str], int] = {}
        telling: list[list[tuple[str, str]]] = []
        at, true_at = [0] * len(KINDS), 0
        for i, (s, e) in enumerate(tokens):
            token = text[s:e]
            gold, failed = 0, ""
            for k in range(len(KINDS)):
                at[k], own, how = _touching(marks[k], s, e, at[k])
                gold, failed = gold or own, failed or how
            hidden = 0
            if told:
                true_at, hidden, _ = _touching(true, s, e, true_at)
            left = i > 0 and active[i - 1] + 1 == active[i]
            right = i + 1 < len(tokens) and active[i] + 1 == active[i + 1]
            word = lambda j: text[slice(*words[j])][:20].lower() if 0 <= j < len(words) else ""  # noqa: B023, E731
            digits = "".join(DIGIT.findall(token))
            g.text.append(n)
            g.start.append(s)
            g.end.append(e)
            g.gold.append(gold or hidden or (OPEN if failed == "many" else 0))
            g.rows.append([
                _row("shape", shapes[i]), _row("sign", "@" in token, token.strip(EDGES)[:1] == "+", token.count("."), min(len(digits), 20)),
                _row("left", shapes[i - 1] if left else ""), _row("right", shapes[i + 1] if right else ""), _row("both", shapes[i], shapes[i - 1] if left else "", shapes[i + 1] if right else ""),
                _row("failed", failed == "test" and not gold), _row("tests", _tests(token, digits)), _row("before", "" if left else word(active[i] - 1)), _row("after", "" if right else word(active[i] + 1)),
            ])
            if left:
                g.chain.append((first + i - 1, first + i))
            bare = "".join(c for c in token.lower() if c.isalnum())
            keys = [("same", bare)] if len(bare) >= 4 else []
            keys += [("digits", digits)] if len(digits) >= 6 else []
            keys += [("name", token.strip(EDGES).lower().split("@")[0])] if names else []
            for key in keys:
                if key in groups and (groups[key], first + i) not in g.skip[-3:]:
                    g.skip.append((groups[key], first + i))
                groups[key] = first + i
            telling.append([key for key in keys if DIGIT.search(key[1]) and len(key[1]) >= 6])
        labelled: dict[tuple[str, str], int] = {}
        for i, own in enumerate(telling):
            if g.gold[first + i] > 0:
                for key in own:
                    labelled.setdefault(key, first + i)
        for i, own in enumerate(telling):
            if g.gold[first + i] <= 0:
                g.known += sorted({(labelled[key], first + i) for key in own if key in labelled})[:1]
    return g


def _hidden(kind: int, span: str, rng: np.random.Generator) -> str:
    """A base span written so that its pattern doesn't find it."""
    digits = "".join(DIGIT.findall(span))
    pick = int(rng.integers(3))
    if kind == 0:
        return span.replace("@", ("(at)", "[at]", "(AT)")[pick])
    if kind == 1:
        return (span.replace(".", "[.]"), span.replace(".", "-"), span.replace(".", ":"))[pick]
    if kind == 2:
        return ("." if pick == 0 else "/" if pick == 1 else "_").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    bare = span.lstrip("+")
    return (bare, bare.split(" ", 1)[-1] if len(digits) > 10 else bare, "00" + bare)[pick]


def _other(rng: np.random.Generator) -> str:
    """A number that is nobody's data."""
    a, b, c, d = (int(x) for x in rng.integers(0, 10_000, 4))
    forms = (f"{1990 + a % 40}-{1 + b % 12:02d}-{1 + c % 28:02d}", f"{1 + a % 28}/{1 + b % 12}/{1990 + c % 40}", f"{a % 20}.{b % 20}.{c % 20}", f"v{a % 9}.{b % 30}", f"{a % 24:02d}:{b % 60:02d}", f"{a},{b % 1000:03d}.{c % 100:02d}", f"{a % 1000}%", f"{a}", f"{a}{b:04d}", f"{a}-{b}", f"#{a}{c}", f"x{a}y", f"{a % 100}x{b % 100}", f"+{a % 90}", f"({1 + a % 30})", f"{a % 9000}-{b % 9000}-{c % 90}/{d % 90}", f"{a}{b:04d}{c:04d}{d:04d}"[:15], f"@{'abcdefgh'[a % 8] * 3}{b}")
    return forms[int(rng.integers(len(forms)))]


def examples(texts: list[str], seed: int = 11) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """texts with their base spans, and again with these hidden and other numbers strewn in."""
    rng = np.random.default_rng(seed)
    out, told = list(texts), [patterns(t)[0] for t in texts]
    for text, spans in zip(texts, list(told), strict=True):
        edits = [(s, e, k, _hidden(k, text[s:e], rng)) for k, s, e in spans]
        gaps = [m.start() for m in re.finditer(" ", text)]
        edits += [(gaps[i], gaps[i], -1, f" {_other(rng)}") for i in sorted(set(rng.integers(0, len(gaps), 3).tolist()))] if gaps else []
        parts, kept, last, size = [], [], 0, 0
        for s, e, k, new in sorted(edits):
            if s < last:
                continue
            parts += [text[last:s], new]
            size += s - last
            if k >= 0:
                kept.append((k, size, size + len(new)))
            size += len(new)
            last = e
        out.append("".join(parts) + text[last:])
        told.append(kept)
    return out, told


@dataclass
class Field:
    table: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros((ROWS, K)), np.zeros((K, K)), AGREE * np.eye(K))

    def unary(self, g: Graph, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Scores of tokens alone, with the observed words beside them."""
        u = self.table[np.array(g.rows)[of]].sum(axis=1)
        ends = np.zeros((len(g.rows), 2), bool)
        if g.chain:
            c = np.array(g.chain)
            ends[c[:, 1], 0] = ends[c[:, 0], 1] = True
        ends = ends[of]
        return u + np.where(ends[:, :1], 0, self.chain[0]) + np.where(ends[:, 1:], 0, self.chain[:, 0])

    @staticmethod
    def fit(g: Graph, epochs: int = 400, rate: float = 0.3, most: int = 20_000, seed: int = 3) -> Field:
        """Weights by pseudolikelihood (each token given its neighbours' labels) over at most ``most`` tokens labelled as outside, which stand for all such, and as many others."""
        f = Field.empty()
        if not g.text:
            return f
        gold, rng = np.array(g.gold), np.random.default_rng(seed)
        outside, inside = (rng.permutation(x)[:most] for x in (np.flatnonzero(gold == 0), np.flatnonzero(gold > 0)))
        of = np.concatenate([outside, inside])
        weight = np.concatenate([np.full(len(outside), (gold == 0).sum() / max(1, len(outside))), np.full(len(inside), (gold > 0).sum() / max(1, len(inside)))])
        place = np.full(len(gold), -1)
        place[of] = np.arange(len(of))

        def seen_by(edges: list[tuple[int, int]], at: int) -> tuple[np.ndarray, np.ndarray]:
            """(place of the end number at, label of the other end) of edges between labelled tokens."""
            e = np.array(edges, np.int64).reshape(-1, 2)
            e = e[(gold[e] != OPEN).all(axis=1) & (place[e[:, at]] >= 0)]
            return place[e[:, at]], gold[e[:, 1 - at]]

        (after, before_label), (before, after_label) = seen_by(g.chain, 1), seen_by(g.chain, 0)
        ends = [seen_by(g.skip, at) for at in (0, 1)]
        linked, linked_label = (np.concatenate([e[i] for e in ends]) for i in (0, 1))
        rows, hot, n = np.array(g.rows)[of], np.eye(K)[gold[of]], weight.sum()
        seen, seen_c, seen_s = 1e-3, 1e-3, 1e-3
        for _ in range(epochs):
            score = f.unary(g, of)
            np.add.at(score, after, f.chain[before_label])
            np.add.at(score, before, f.chain[:, after_label].T)
            np.add.at(score, linked, f.skip[linked_label])
            p = np.exp(score - score.max(axis=1, keepdims=True))
            near = (hot - p / p.sum(axis=1, keepdims=True)) * weight[:, None]
            pull = np.stack([np.bincount(rows.ravel(), np.repeat(near[:, k], rows.shape[1]), ROWS) for k in range(K)], axis=1) / n - 1e-5 * f.table
            pull_c, pull_s = np.zeros((K, K)), np.zeros((K, K))
            np.add.at(pull_c, before_label, near[after])
            np.add.at(pull_c.T, after_label, near[before])  # a view: fills the columns
            np.add.at(pull_s, linked_label, near[linked])
            pull_c, pull_s = pull_c / n, (pull_s + pull_s.T) / (2 * n) - 1e-3 * (f.skip - AGREE * np.eye(K))
            seen, seen_c, seen_s = seen + pull**2, seen_c + pull_c**2, seen_s + pull_s**2
            f.table += rate * pull / np.sqrt(seen)
            f.chain += rate * pull_c / np.sqrt(seen_c)
            f.skip += rate * pull_s / np.sqrt(seen_s)
        return f

    def marginals(self, g: Graph, settled: float = 1e-3, damp: float = 0.3, rounds: int = 2000) -> np.ndarray:
        """Beliefs [token, label] of loopy sum-product belief propagation, until no message moves by more than settled (loops that never settle end after the given rounds)."""
        u = self.unary(g)
        gold = np.array(g.gold)
        u[gold > 0] -= 1e6 * (1 - np.eye(K)[gold[gold > 0]])  # observed
        if g.known:
            source, target = np.array(g.known).T
            np.add.at(u, target, REPEATS * np.eye(K)[gold[source]])  # what an observed end sends along its link
        pairs = [(np.array(e, np.int64), w) for e, w in ((g.chain, self.chain), (g.skip, self.skip)) if e]
        if pairs:
            source = np.concatenate([x for e, _ in pairs for x in (e[:, 0], e[:, 1])])
            target = np.concatenate([x for e, _ in pairs for x in (e[:, 1], e[:, 0])])
            weight = np.concatenate([x for e, w in pairs for x in (np.broadcast_to(w, (len(e), K, K)), np.broadcast_to(w.T, (len(e), K, K)))])
            sizes = [len(e) for e, _ in pairs]
            back = np.concatenate([x + off for off, n in zip(np.cumsum([0, *(2 * s for s in sizes)]), sizes, strict=False) for x in (np.arange(n, 2 * n), np.arange(n))])
            mail = np.zeros((len(source), K))
            for _ in range(rounds):
                belief = u.copy()
                np.add.at(belief, target, mail)
                left = belief[source] - mail[back]
                new = left[:, :, None] + weight
                top = new.max(axis=1)
                new = top + np.log(np.exp(new - top[:, None]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                new = damp * mail + (1 - damp) * new
                moved = np.abs(new - mail).max()
                mail = new
                if moved < settled:
                    break
            u = u.copy()
            np.add.at(u, target, mail)
        p = np.exp(u - u.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def spans(self, texts: list[str], sure: float = SURE) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
        """For each text its base spans and all its spans, (kind number, start, end) by kind and start."""
        found = [patterns(t) for t in texts]
        g = build(texts, found)
        more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if g.text:
            p = self.marginals(g)
            label, chained = p.argmax(axis=1), set(g.chain)
            runs: list[list[int]] = []
            for i in np.flatnonzero((label > 0) & (p.max(axis=1) >= sure)).tolist():
                if runs and label[runs[-1][-1]] == label[i] and (runs[-1][-1], i) in chained:
                    runs[-1].append(i)
                else:
                    runs.append([i])
            taken: dict[int, list[tuple[int, int]]] = {}
            for run in runs:
                n, s, e = g.text[run[0]], g.start[run[0]], g.end[run[-1]]
                whole = texts[n][s:e]
                s, e = s + len(whole) - len(whole.lstrip(EDGES)), e - len(whole) + len(whole.rstrip(EDGES))
                if n not in taken:  # base spans as far as they reach, by start
                    taken[n] = _joined([(a, b) for _, a, b in found[n][0]])
                i = bisect.bisect_left(taken[n], (e, 0)) - 1
                if s < e and (i < 0 or taken[n][i][1] <= s):
                    more[n].append((int(label[run[0]]) - 1, s, e))
        return [(good, sorted(good + extra)) for (good, _), extra in zip(found, more, strict=True)]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one, by start."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def fit(docs: DataFrame, sample: int = 1500, stretch: int = 4000) -> Field:
    """A field from at most ``sample`` stretches of that many characters with a digit or @, drawn evenly from all stretches of all whole texts.

    Both bounds concern fitting alone. Null ids and texts are left out; a table without such a text gives a field that adds nothing.
    """
    known = docs.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id", "text", F.ceil(F.length("text") / stretch).cast("long").alias("n"))
    n = known.agg(F.sum("n")).first()[0]
    if not n:
        return Field.empty()
    cut = known.select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    draw = F.pmod(F.xxhash64("doc_id", "i"), F.lit(1 << 30))
    drawn = cut.select(draw.alias("draw"), "doc_id", "i", "text").where(F.col("draw") < int(min(1.0, (2.0 * sample + 50) / n) * (1 << 30)))
    part = drawn.select("draw", "doc_id", "i", F.expr(f"substring(text, cast(i * {stretch} + 1 as int), {stretch})").alias("text")).where(F.col("text").rlike("[0-9@]"))
    rows = part.sort("draw", "doc_id", "i", "text").limit(sample).collect()
    texts, told = examples([r["text"] for r in rows])
    return Field.fit(build(texts, [patterns(t) for t in texts], told))


def find(docs: DataFrame, field: Field, chars_at_once: int = 300_000) -> DataFrame:
    """docs with base and spans added: arrays of (kind number, start, end) in code points, end exclusive.

    Null and empty texts have none; repeated rows are all kept; an empty table
    gives an empty result. Columns of docs named base or spans are replaced.
    """
    docs = lean(docs.drop("base", "spans"))
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            said, part, size = [], [], 0
            for t in b.column(at).to_pylist():
                part.append(t or "")
                size += len(part[-1])
                if size >= chars_at_once:
                    said += field.spans(part)
                    part, size = [], 0
            said += field.spans(part) if part else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([as_rows(s[0]) for s in said], kind), pa.array([as_rows(s[1]) for s in said], kind)], [*b.schema.names, "base", "spans"])

    extra = "base array<struct<kind:int,start:int,end:int>>, spans array<struct<kind:int,start:int,end:int>>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(extra).fields])
    return docs.mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """docs with every span in text replaced by its kind in brackets; a null text stays null. Overlapping spans become one, named after the first."""
    held = {c: unique_name(docs, f"own_{c}") for c in docs.columns if c.lower() in ("base", "spans")}
    found = find(docs.withColumnsRenamed(held), field)
    name = unique_name(found, "redacted")
    at, spans_at = found.columns.index("text"), found.columns.index("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            out = []
            for text, spans in zip(b.column(at).to_pylist(), b.column(spans_at).to_pylist(), strict=True):
                parts, last = [], 0
                merged: list[list[int]] = []
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if merged and s["start"] < merged[-1][2]:
                        merged[-1][2] = max(merged[-1][2], s["end"])
                    else:
                        merged.append([s["kind"], s["start"], s["end"]])
                for k, s, e in merged:
                    parts += [text[last:s], f"[{KINDS[k].upper()}]"]
                    last = e
                out.append(None if text is None else "".join(parts) + text[last:])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, name])

    done = found.mapInArrow(run, StructType([*found.schema.fields, StructField(name, StringType())]))
    return done.select(*[F.col(name).alias("text") if c == "text" else F.col(held.get(c, c)).alias(c) for c in docs.columns])
