"""The training-data operators against brute force on small tables, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.llm import ann, bktree, chat, decontaminate, langid, packing, pii, sharding, simhash, substrings, urlfilter
from marlstone.operators import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def prose(seed, n, vocab=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, vocab, n))


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def brute_fingerprint(text, n=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.fixture(scope="module")
def copies(spark):
    base = prose(1, 300)
    near = [base.replace(f"w{k}", "x", 1) for k in range(12)]
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \t\n"), (6, "One two"), (7, prose(2, 90)), (8, "ÉA Bb é"), (None, prose(3, 50)), *[(20 + i, t) for i, t in enumerate(near)], (60, prose(4, 30_000))]
    return rows


def test_simhash(spark, copies):
    docs = frame(spark, copies).withColumns({"fp": F.lit("clash"), "component_id": F.lit(0), "key": F.lit(1)})
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs, shard_rows=3).collect()}
    fps = [(d, brute_fingerprint(t)) for d, t in copies]
    label = {i: d for i, (d, _) in enumerate(fps)}
    big = 1 << 60
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(fps):
            for j, (_, b) in enumerate(fps):
                if (a ^ b).bit_count() <= 3 and (label[j] if label[j] is not None else big) < (label[i] if label[i] is not None else big):
                    label[i], changed = label[j], True
    want = {(d, f - (1 << 64) if f >> 63 else f): label[i] for i, (d, f) in enumerate(fps)}
    assert got == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.integers(0, 6))
def test_trees(prints, radius):
    prints += [p ^ (1 << (p % 64)) for p in prints[:20]]
    fp, shard = np.array(prints, np.uint64), np.arange(len(prints)) % 3
    found = {(int(i), int(j)) for u, v in bktree.Forest(shard, fp).within(radius, budget=50) for i, j in zip(u, v, strict=True)}
    want = {(i, j) for i in range(len(prints)) for j in range(len(prints)) if i != j and i % 3 == j % 3 and (prints[i] ^ prints[j]).bit_count() <= radius}
    assert found == want


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 80, (50, 2))] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(frame(spark, edges, "u long, v long")).collect()}
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in range(200):
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components.components(frame(spark, [], "u long, v long")).count() == 0


def test_deduplicated(spark, copies):
    docs = frame(spark, [(*r, "kept") for r in copies], DOCS + ", digest_ string").withColumn("item", F.lit(5))
    kept = simhash.deduplicated(docs, shard_rows=4).collect()
    ids = sorted((r.doc_id for r in kept if r.doc_id is not None))
    assert ids == [1, 3, 4, 6, 7, 8, 60] or ids == [1, 3, 6, 7, 8, 60]  # empty texts of different white space are alike
    assert set(kept[0].asDict()) == {"doc_id", "text", "digest_", "item"} and sum(r.doc_id is None for r in kept) == 1
    far = frame(spark, [(i, prose(50 + i, 120)) for i in range(20)])
    assert simhash.deduplicated(far).count() == 20 and simhash.deduplicated(frame(spark, [])).count() == 0


def test_chains_of_near_copies(spark):
    texts = {}
    for g in range(6):  # two edited copies of an original, itself not the smallest: 0.86 to the original, 0.73 to each other
        words = prose(700 + g, 200, 5000).split()
        for d, at in ((3 * g, (20, 60, 100)), (3 * g + 1, ()), (3 * g + 2, (120, 150, 180))):
            texts[d] = " ".join("x" if i in at else w for i, w in enumerate(words))
    sets = {d: set(simhash.shingle_hashes(t, 5).tolist()) for d, t in texts.items()}
    least = {d: d for d in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    unrelated = [(100 + i, prose(900 + i, 120, 5000)) for i in range(10)]
    for others in ([], unrelated):
        kept = {r.doc_id for r in simhash.deduplicated(frame(spark, [*texts.items(), *others])).collect()}
        assert kept == set(least.values()) | {d for d, _ in others}


def brute_groups(sets, similarity):
    least = dict.fromkeys(sets)
    for d in sets:
        least[d] = d
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if least[b] < least[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                    least[a], changed = least[b], True
    return least


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_alike(similarity):
    rng = np.random.default_rng(31)
    for _ in range(60):
        base = rng.choice(500, int(rng.integers(1, 40)), replace=False)
        sets = {}
        for d in range(int(rng.integers(1, 20))):
            kept = base[rng.random(len(base)) > rng.random() * 0.3].tolist()
            sets[d] = set(kept + rng.integers(500, 520, int(rng.integers(0, 1 + len(base) // 5))).tolist()) or {0}
        label = simhash.alike([np.array(sorted(x), np.uint64) for x in sets.values()], similarity).tolist()
        least = brute_groups(sets, similarity)
        assert {(label[a] == label[b]) == (least[a] == least[b]) for a in sets for b in sets} == {True}


def crowd():
    """Two crowds of edited copies: of the first hardly two are similar, of the second those of one edit are."""
    rng, texts = np.random.default_rng(41), {}
    for c, edits in enumerate(((3, 4), (1, 3, 4))):
        words = prose(31_000 + c, 150, 5000).split()
        for i in range(100):
            own = list(words)
            for at in rng.choice(150, edits[i % len(edits)], replace=False):
                own[at] = f"own{c}_{i}_{at}"
            texts[1000 * c + i] = " ".join(own)
    return texts


@pytest.mark.parametrize("unit_rows", [10, 60, 1000])  # in blocks, taken apart, whole
def test_crowds_of_near_copies(spark, monkeypatch, unit_rows):
    texts, tables, saved = crowd(), [], simhash.saved
    least = brute_groups({d: set(simhash.shingle_hashes(t, 5).tolist()) for d, t in texts.items()}, 0.8)
    assert 60 < len(set(least.values())) < 180
    monkeypatch.setattr(simhash, "saved", lambda df: tables.append(saved(df)) or tables[-1])
    rows = [*texts.items(), (0, texts[0]), (None, texts[1000])]
    kept = [r.doc_id for r in simhash.deduplicated(frame(spark, rows), **({} if unit_rows == 1000 else {"unit_rows": unit_rows})).collect()]
    assert sorted(kept) == sorted(set(least.values()))
    if unit_rows == 1000:  # no table of pairs
        assert max(t.count() for t in tables) <= len(rows)


def test_met_loses_no_pair():
    rng = np.random.default_rng(43)
    for classes in (2000, 4):
        for _ in range(50):
            n = int(rng.integers(2, 40))
            size = rng.integers(5, 60, n)
            most = size + rng.integers(-10, 12, n)
            least = bktree.least_labels(n, simhash._met(np.arange(n), size, most, classes), np.arange(n))
            for i in range(n):
                assert all(least[i] == least[j] for j in range(n) if i != j and size[i] <= most[j] and size[j] <= most[i])


def test_recall_at_the_least_similarity(spark):
    rng = np.random.default_rng(17)
    rows, pairs = [], 0
    for g in range(400):
        words = prose(20_000 + g, int(rng.integers(60, 400)), 50_000).split()
        most = int((len(words) - 4) / 9 / 5)  # edits of five shingles each that leave a similarity of 0.8
        other = list(words)
        for at in (np.linspace(5, len(words) - 6, most).astype(int) if most else []):
            other[at] = "edited"
        a, b = (set(simhash.shingle_hashes(" ".join(x), 5).tolist()) for x in (words, other))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            pairs += 1
            rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(other))]
    kept = simhash.deduplicated(frame(spark, rows)).count()
    assert pairs > 200 and (2 * pairs - kept) / pairs >= 0.93, (pairs, 2 * pairs - kept)


def brute_infix(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_edit_distance(item, text):
    assert decontaminate.infix_distance(item, text, 9)[0] == brute_infix(item, text)


def test_decontamination(spark):
    items = [(i, prose(100 + i, 15 + 5 * i, 3000)) for i in range(8)] + [(90, None), (91, ""), (92, "w1 w2")]
    rng = np.random.default_rng(5)
    rows, want = [(900, None), (901, ""), (902, prose(9, 400, 3000))], set()
    for n in range(60):
        item, text = items[n % 8]
        words = text.split()
        for _ in range(n % 3):
            words[int(rng.integers(len(words)))] = "edited"
        rows.append((n, f"{prose(300 + n, 40, 5000)} {' '.join(words).title()}, {prose(600 + n, 40, 5000)}"))
        want.add((n, item))
    rows.append((0, rows[3][1]))
    found = decontaminate.find_leaks(frame(spark, rows).withColumn("item_id", F.lit(1)), frame(spark, items, "item_id long, text string").withColumn("doc_id", F.lit(2)), items_at_once=5)
    got = [(r.doc_id, r.item_id, r.distance) for r in found.collect()]
    strong = {(d, i) for d, i, _ in got if i < 90}
    assert len(want - strong) <= 1 and strong <= want
    assert all(dist <= 2 for _, i, dist in got if i < 90) and sum(d == 0 and i == 0 for d, i, _ in got) == 2
    left = {r.doc_id for r in decontaminate.clean(frame(spark, rows), frame(spark, items[:8], "item_id long, text string")).collect()}
    assert {900, 901, 902} <= left and len(left) <= 4
    assert decontaminate.find_leaks(frame(spark, []), frame(spark, items, "item_id long, text string")).count() == 0
    assert decontaminate.find_leaks(frame(spark, rows), frame(spark, [], "item_id long, text string")).count() == 0


def test_few_leaks_shuffle_no_text(spark):
    items = [(1, prose(100, 30, 3000))]
    rows = [(i, f"{prose(300 + i, 40, 5000)} {items[0][1] if i == 3 else ''}") for i in range(12)]
    left = decontaminate.clean(frame(spark, rows), frame(spark, items, "item_id long, text string"))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(12) if i != 3]


def test_decontamination_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    items = [(i, prose(400 + i, n, 2000)) for i, n in enumerate((1, 3, 5, 8, 12, 15, 30, 59, 71, 100, 142, 300))]
    rows = []
    for n in range(48):
        codes = np.array([int(w[1:]) + 1 for w in items[n % 12][1].split()])
        text = " ".join("x" if c == 0 else f"w{c - 1}" for c in decontaminate.edited(codes, int(rng.integers(0, len(codes) // 3 + 1)), rng))
        rows.append((n, f"{prose(800 + n, 30, 2000)} {text} {prose(900 + n, int(rng.integers(0, 90)), 2000)}"))
    want = {}
    for d, text in rows:
        for i, item in items:
            distance = decontaminate.infix_distance(item.split(), text.split(), len(item.split()))[0]
            if distance <= len(item.split()) // 5:
                want[d, i] = distance
    assert brute_infix(items[7][1].split(), rows[7][1].split()) == decontaminate.infix_distance(items[7][1].split(), rows[7][1].split(), 59)[0]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(frame(spark, rows), frame(spark, items, "item_id long, text string")).collect()}
    assert got.items() <= want.items() and len(got) >= 0.97 * len(want)
    assert all(k in got for k, distance in want.items() if distance == 0)


@pytest.mark.parametrize("words", [10, 15, 24, 59, 71, 100, 142, 300])
def test_decontamination_at_the_limit(words):
    rng = np.random.default_rng(words)
    items = [(i, prose(5000 + i, words, 5000)) for i in range(40)]
    index = decontaminate.Index(items, 0.2, 0.97, 4)
    assert all(c["recall"] >= 0.97 for c in index.classes)
    texts, hits = [], 0
    for i, item in items:
        for spread in (1.0, 0.5):  # edits anywhere, or in the first half alone
            part = np.array([int(w[1:]) + 1 for w in item.split()])
            cut = int(len(part) * spread)
            codes = np.concatenate([decontaminate.edited(part[:cut], len(part) // 5, rng), part[cut:]])
            texts.append((i, f"{prose(i, 37, 5000)} " + " ".join("x" if c == 0 else f"w{c - 1}" for c in codes) + f" {prose(i + 1, 41, 5000)}"))
    for n, item_id, *_ in index.matches([t for _, t in texts]):
        hits += item_id == texts[n][0]
    assert hits / len(texts) >= 0.92, hits / len(texts)


def language_text(lang, seed, n=60):
    parts = {"xx": ["ka", "to", "mi", "ren"], "yy": ["sch", "ein", "ung", "ber"], "zz": ["eau", "oux", "ille", "tre"]}[lang]
    rng = np.random.default_rng(seed)
    return " ".join("".join(parts[i] for i in rng.integers(0, 4, rng.integers(1, 4))) for _ in range(n))


def test_language(spark):
    rows = [(i, language_text("xyz"[i % 3] * 2, i), "xyz"[i % 3] * 2) for i in range(240)]
    rows += [(1000, None, "xx"), (1001, "123 !?", None), (1002, "", "yy"), (None, language_text("xx", 7), "xx"), (1003, language_text("yy", 5, 9000), None), (5, language_text("xx", 1), None)]
    docs = frame(spark, rows, DOCS + ", lang string").withColumns({"score": F.lit("clash"), "held_out": F.lit(1)})
    model = langid.fit(docs)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    plain = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and r.lang]
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in plain)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id is not None and r.doc_id >= 1000} == {1000: "und", 1001: "und", 1002: "und", 1003: "yy"}
    mixed = model.predict([f"{language_text('xx', 900, 30)} {language_text('yy', 901, 10)}"])[0]
    assert mixed[0] == "xx" and 0.6 < mixed[1] < 0.9
    assert langid.fit(docs.where("lang is null")).predict(["abc"]) == [("und", 0.0)]
    strange = ["qxz wvk jjq zzx qqv kxw vzq xjw", "привет мир как дела сегодня", "漢字仮名交じり文の例です漢字仮名交じり文の例です", "thequick brownfox jumpsover thelazydog"]
    at_home = [language_text("zz", 31, 4), f"{language_text('xx', 32, 9)} {language_text('yy', 33, 9)} {language_text('zz', 34, 9)}", language_text("yy", 35, 2000)]
    assert all(known < model.least for _, _, known in model.judge(strange)) and all(known >= model.least for _, _, known in model.judge(at_home))
    held = {r.doc_id: r.h for r in docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0) for d, h in held.items())


def test_language_of_held_out_documents(spark):
    from pathlib import Path

    if not Path("/root/testdata/sf0.01").exists():
        pytest.skip("no tables")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    got = langid.identify(docs, model).where(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.98
    assert all(r.known >= model.least for r in got)


def test_forward_backward():
    rng = np.random.default_rng(0)
    lengths = np.array([5, 0, 130, 64, 65, 1])
    emit, moves = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got, at = langid.posteriors(emit, lengths, moves), 0
    for n in lengths:
        e, a = np.exp(emit[at : at + n]), np.exp(moves)
        forward, back = [], np.ones(3)
        for t in range(n):
            forward.append((forward[-1] @ a if t else np.ones(3)) * e[t])
            forward[-1] /= forward[-1].sum()
        for t in range(n - 1, -1, -1):
            p = forward[t] * back
            assert np.allclose(p / p.sum(), got[at + t], atol=1e-6)
            back = a @ (e[t] * back)
            back /= back.sum()
        at += n


TEXTS = st.text(alphabet="\\[]</s>INST ol\ngen‹é", max_size=20)


def test_chat_round_trip(spark):
    rows = [("t", 1, None, 0.0, "user", "a </s>[INST] ok [/INST]\\l \\"), ("t", 2, 1, 1.0, "assistant", "b\\g<s>"), ("t", 3, 2, 0.5, "us\ner[", "x"), ("t", 4, 1, 5.0, "assistant", None), ("t", 4, 1, 5.0, "assistant", None), ("u", 1, 9, None, None, ""), ("v", 1, 2, 0.0, "user", "cycle"), ("v", 2, 1, 0.0, "user", "cycle"), (None, 1, None, 0.0, "user", "x"), *[("long", i, i - 1 if i else None, 0.1, "assistant" if i % 2 else "user", f"m{i}") for i in range(300)]]
    trees = frame(spark, rows, "tree string, id long, parent long, score double, role string, text string").withColumn("formatted", F.lit(1))
    shown = chat.format_trees(trees).withColumns({"turns": chat.turns_of(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}).collect()
    got = {(r.tree, r.leaf): ([tuple(t) for t in r.turns], r.loss, r.rank) for r in shown}
    assert set(got) == {("t", 3), ("t", 4), ("u", 1), ("long", 299)}
    a = ("user", "a </s>[INST] ok [/INST]\\l \\")
    assert got["t", 3] == ([a, ("assistant", "b\\g<s>"), ("us\ner[", "x")], "b\\g<s>", 2) and got["t", 4] == ([a, ("assistant", "")], "", 1)
    assert got["u", 1] == ([("", "")], "", 1) and [t[1] for t in got["long", 299][0]] == [f"m{i}" for i in range(300)]
    assert [r.leaf for r in chat.format_trees(trees, top=1).where("tree = 't'").collect()] == [4]
    assert chat.format_trees(trees.limit(0)).count() == 0
    texts = ["", "\\", "<s>[INST]", "\\e\\l\\g", "a\\n</s>", "[/INST]\n"]
    back = frame(spark, [(i, t) for i, t in enumerate(texts)]).select("doc_id", chat.unescaped(chat.escaped(F.col("text"))).alias("t")).sort("doc_id").collect()
    assert [r.t for r in back] == texts


def brute_pii(text):
    spans = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer({"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 13 <= len(digits) <= 19 and total % 10 == 0) or (kind == "phone" and 9 <= len(digits) <= 15):
                spans.append((k, *m.span()))
    return spans


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab@.+-() 0123456789%_é", max_size=60))
def test_patterns(text):
    assert pii.patterns(text)[0] == brute_pii(text)


def test_personal_data(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f"Call +1 (269) 555-{1000 + i} or mail user{i}@mail.example.com today, host 10.0.{i % 200}.7 of {i} units") for i in range(300)]
    rows += [(900, None), (901, ""), (902, "plain words only"), (903, "card 4111 1111 1111 1111 and 4111 1111 1111 1112"), (904, "x " * 20000 + "a@b.co"), (905, "+1 (269) 555-7777 again 269 555-7777 said, 555-7777"), (905, "ïé a@b.co")]
    docs = frame(spark, rows).withColumns({"spans": F.lit(1), "base": F.lit("x"), "redacted": F.lit(2)})
    field = pii.fit(docs)
    got = pii.find(docs, field).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r.base] == brute_pii(r.text or "") and {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
    assert not next(r for r in got if r.doc_id == 902).spans
    clean = {r.doc_id: r.text for r in pii.redact(docs, field).collect()}
    assert clean[900] is None and clean[903].startswith("card [CARD] and 4111") and clean[3].startswith("Call [PHONE] or mail [EMAIL] today, host [IP] of 3 units") and set(pii.redact(docs, field).columns) == set(docs.columns)
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0
    _ = rng


def test_skip_links_spread_labels():
    g = pii.build(["a 5551234567 b 5551234567 c 5551234567"], [([], [])])
    assert g.skip and not g.chain
    field = pii.Field.empty()
    assert field.unary(g).shape == (3, pii.K)
    field.table[g.rows[1][-2], 4] += 1.0  # what stands before the second one
    p = field.marginals(g)
    alone = np.exp([0, 0, 0, 0, 1.0]) / np.exp([0, 0, 0, 0, 1.0]).sum()
    assert (p[:, 4] > 1 / pii.K + 0.01).all() and p[1, 4] > alone[4] - 1e-6


def test_a_label_crosses_a_long_group():
    g = pii.build(["x 5551234567 y " * 300], [([], [])])
    field = pii.Field.empty()
    field.skip = 8.0 * np.eye(pii.K)
    field.table[g.rows[0][-2], 4] = 0
    u = field.unary
    field.unary = lambda graph: u(graph) + np.eye(pii.K)[4] * (np.arange(len(graph.text)) == 0)[:, None] * 6.0
    assert (field.marginals(g)[:, 4] > 0.6).all()


def added(field, texts):
    return [[(pii.KINDS[k], t[s:e]) for k, s, e in sorted(set(found) - set(base))] for t, (base, found) in zip(texts, field.spans(texts), strict=True)]


def personal(seed):
    rng = np.random.default_rng(seed)
    a, b, c, d = (int(x) for x in rng.integers(0, 256, 4))
    digits = [int(x) for x in rng.integers(0, 10, 15)]
    check = (10 - sum(sum(divmod(2 * x, 10)) if i % 2 == 0 else x for i, x in enumerate(reversed(digits))) % 10) % 10
    card = "".join(map(str, [*digits, check]))
    return ("email", f"{language_text('xx', seed, 1)}.{a}@mail{b % 9}.example.com"), ("ip", f"{a}.{b}.{c}.{d}"), ("card", card), ("phone", f"+1 ({a:03d}) 555-{1000 + b * 30 + c}")


def planted(seeds):
    """Texts with one item of personal data each, and with other numbers."""
    rng = np.random.default_rng(99)
    words = lambda s, n: language_text("xx", s, n)
    return [f"{words(s, 12)} {personal(s)[s % 4][1]} {words(s + 1, 8)} {pii._other(rng)} {words(s + 2, 6)}" for s in seeds]


def test_hidden_personal_data_is_found():
    train, fresh = planted(range(800)), planted(range(5000, 5400))
    texts, told = pii.examples(train)
    field = pii.Field.fit(pii.build(texts, [pii.patterns(t) for t in texts], told))
    hidden, true = pii.examples(fresh, seed=12)
    hidden, true = hidden[len(fresh) :], true[len(fresh) :]
    right = wanted = given = 0
    for text, spans, (base, found) in zip(hidden, true, field.spans(hidden), strict=True):
        wanted += sum(all(e <= a or b <= s for _, a, b in base) for _, s, e in spans)  # what no pattern touches
        more = set(found) - set(base)
        given += len(more)
        right += sum(any(k == k2 and a < e and s < b for k2, a, b in spans) for k, s, e in more)
    assert wanted > 200 and right / given >= 0.95 and right / wanted >= 0.8, (right, given, wanted)
    # in texts without hidden data nothing is added
    assert sum(map(len, added(field, fresh))) <= 2


def test_numbers_run_together():
    train = planted(range(800))
    texts, told = pii.examples(train)
    field = pii.Field.fit(pii.build(texts, [pii.patterns(t) for t in texts], told))
    text = "aber so +1 (826) 555-4081 190.137.223.204 du mehr"
    base, found = field.spans([text])[0]
    assert [text[s:e] for _, s, e in base] == ["190.137.223.204"]
    assert (3, text.index("+1"), text.index(" 190")) in found


def test_repeats_of_labelled_numbers():
    texts = ["call +1 555-123-4567 or 555-123-4567 now", "first 15551234567 then +15551234567", "mail user12@example.org by user12 ok", "call +49 30 1200 4567 for 1200 euros", "in 2023 and 2024 on 12 items"]
    texts.append("+1 555-123-4567 " + "and 555-123-4567 " * 40)
    field = pii.Field.fit(pii.build(texts, [pii.patterns(t) for t in texts]))
    assert added(field, texts) == [[("phone", "555-123-4567")], [("phone", "15551234567")], [("email", "user12")], [], [], [("phone", "555-123-4567")] * 40]


def test_long_runs_take_linear_time():
    import time

    field = pii.Field.fit(pii.build(["call +1 555-123-4567"], [pii.patterns("call +1 555-123-4567")]))
    n = 300_000
    runs = ["漢" * n, "a" * n + "@", "a." * n, "@" * n, "a@" * n, "1" * n, "1." * n, "0" * n + ".1.2.3", "1.2.3." + "0" * n, "+1" + "(" * n, "+" * n, "1 " * n, "x1 " * (n // 10), "a@b." * n, "+1 555-123-4567 " * 3000]
    for text in runs:
        began = time.time()
        base, found = field.spans([text])[0]
        assert time.time() - began < 30, text[:10]
        assert set(base) <= set(found)


def exact_marginals(u, edges):
    import itertools

    k, n = u.shape[1], len(u)
    p = np.zeros_like(u)
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(u[i, y[i]] for i in range(n)) + sum(m[y[a], y[b]] for a, b, m in edges))
        for i in range(n):
            p[i, y[i]] += w
    return p / p.sum(axis=1, keepdims=True)


def test_belief_propagation_is_exact_on_trees():
    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii.ROWS, pii.K)), rng.normal(size=(pii.K, pii.K)), rng.normal(size=(pii.K, pii.K)))
    field.skip = field.skip + field.skip.T
    g = pii.Graph([0] * 4, [0] * 4, [1] * 4, [0] * 4, [[1], [2], [3], [4]], [(0, 1), (1, 2)], [(1, 3)])
    want = exact_marginals(field.unary(g), [(0, 1, field.chain), (1, 2, field.chain), (1, 3, field.skip)])
    assert np.allclose(field.marginals(g, settled=1e-9), want, atol=1e-4)


def test_packing(spark):
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, prose(i, 10 + 37 * i)) for i in range(40)] + [(100, None), (101, ""), (102, "a<|endoftext|>b  \n c"), (103, "é漢字\u00a0x" * 900), (5, prose(5, 195))]
    got = packing.pack(frame(spark, rows).withColumns({"cls": F.lit("clash"), "offset": F.lit(1)}), capacity=512).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 512).all()
    in_order = got.sort_values(["sequence_id", "offset"])
    assert (in_order.groupby("sequence_id").length.cumsum() - in_order.length == in_order.offset).all()
    want = []
    for d, t in rows:
        ids = np.array(full.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        mine = got[got.doc_id == d]
        want += [(d, a, min(512, len(ids) - a), zlib.crc32(ids[a : a + 512].tobytes()), len(ids)) for a in range(0, len(ids), 512)]
        assert len(mine)
    assert sorted(want) == sorted(map(tuple, got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].to_numpy().tolist()))
    assert got.length.sum() / (got.sequence_id.nunique() * 512) > 0.9
    assert packing.pack(frame(spark, [])).count() == 0


def test_packing_of_long_runs(spark):
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    runs = [" " * 1_000_000, "a" + "\n" * 50_000 + "b", " \t" * 30_000 + "x", "\u00a0" * 20_000, "z" * 300_000, "漢字" * 60_000, "7" * 100_000, "!?" * 60_000]
    got = packing.pack(frame(spark, list(enumerate(runs))), capacity=2048).toPandas()
    for d, text in enumerate(runs):
        ids = np.array(full.encode(text, add_special_tokens=False).ids + [1], "<u4")
        mine = got[got.doc_id == d].sort_values("start")
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[a : a + 2048].tobytes()) for a in range(0, len(ids), 2048)]


def test_packing_splits_a_common_length(spark):
    rows = [(i, f"same words {i % 7}") for i in range(900)] + [(i, prose(i, 40)) for i in range(900, 950)] + [(3, "same words 3")]
    got = packing.pack(frame(spark, rows), capacity=64, rank_rows=20).toPandas()
    assert len(got.sequence_id.unique()) >= 1 and (got.groupby("sequence_id").length.sum() <= 64).all()
    assert got[got.start == 0].shape[0] == len(rows)
    in_order = got.sort_values(["sequence_id", "offset"])
    assert (in_order.groupby("sequence_id").length.cumsum() - in_order.length == in_order.offset).all()


def test_column_generation():
    rng = np.random.default_rng(2)
    for _ in range(5):
        histogram = {int(s): int(rng.integers(1, 60)) for s in rng.integers(1, 65, 12)}
        plans = packing.plan(histogram, 64)
        held = Counter()
        for pattern, times in plans:
            assert sum(s * a for s, a in pattern.items()) <= 64
            held.update({s: a * times for s, a in pattern.items()})
        assert all(held[s] >= n for s, n in histogram.items())
        bins, least = sum(t for _, t in plans), sum(s * n for s, n in histogram.items()) / 64
        big = sum(n for s, n in histogram.items() if s > 32)
        assert bins <= max(least, big) * 1.15 + 6
    value, taken = packing.best_pattern(np.array([1.0, 1.6]), np.array([3, 5]), 11)
    assert value == pytest.approx(3.6) and taken.tolist() == [2, 1]
    assert packing.plan({}, 64) == []


def brute_shuffle(spark, rows, shards, seed, buckets):
    """Slots by the plain algorithm: bucket lists, swapped in place."""
    docs = frame(spark, rows)
    draw = lambda *of: [r[0] for r in frame(spark, list(of), "a long, s int, b int, i int").select(F.xxhash64(F.lit(seed + 2), "s", "b", "i")).collect()]
    named = docs.select("doc_id", "text", sharding.shard_of(F.col("doc_id"), shards, seed).alias("s"), F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(buckets)).cast("int").alias("b")).collect()
    held = {}
    for r in named:
        held.setdefault((r.s, r.b), []).append((r.doc_id, r.text))
    wanted = [(0, s, b, i) for (s, b), got in sorted(held.items()) for i in range(len(got))]
    draws = dict(zip([w[1:] for w in wanted], draw(*wanted), strict=True))
    out, at = [], Counter()
    first = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
    for (s, b), got in sorted(held.items()):
        got, mixed = sorted(got, key=first), []
        for i, row in enumerate(got):
            j = draws[s, b, i] % (i + 1)
            mixed.append(row)
            mixed[i], mixed[j] = mixed[j], row
        out += [(*row, s, at[s] + i) for i, row in enumerate(mixed)]
        at[s] += len(got)
    return out


def test_sharding(spark, tmp_path):
    rows = [(i, prose(i, i % 50)) for i in range(800)] + [(None, None), (None, "x"), (5, ""), (5, ""), (6, prose(1, 5000))]
    docs = frame(spark, rows).withColumns({"shard": F.lit("clash"), "rec": F.lit(1), "bucket": F.lit(2), "h": F.lit(3)})
    got = sharding.external_shuffle(docs, shards=7, bucket_bytes=2000)
    pdf = got.toPandas()
    assert len(pdf) == len(rows) and set(pdf.columns) == {"doc_id", "text", "rec", "bucket", "h", "shard", "slot"}
    for _, part in pdf.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert Counter(pdf.text.fillna("∅")) == Counter("∅" if t is None else t for _, t in rows)
    assert pdf.groupby("shard").size().min() > 60
    order = pdf[pdf.shard == 0].sort_values("slot").doc_id.dropna().tolist()
    assert order != sorted(order)
    both = frame(spark, rows).select("doc_id", sharding.shard_of(F.col("doc_id"), 7, 3).alias("a"), sharding.shard_of(F.col("doc_id"), 8, 3).alias("b")).collect()
    assert all(r.a == r.b or r.b == 7 for r in both) and any(r.b == 7 for r in both)
    assert sharding.external_shuffle(frame(spark, []), 4).count() == 0
    path = str(tmp_path / "shards")
    sharding.write_shards(got, path)
    assert sorted(map(str, sharding.read_shards(spark, path, got.schema).collect())) == sorted(map(str, got.collect()))


def test_slots_follow_from_the_rows_alone(spark):
    rows = [(i, prose(i, i % 50)) for i in range(400)] + [(None, None), (None, "x"), (5, ""), (5, "")]
    want = sorted(brute_shuffle(spark, rows, 3, 20240607, 5), key=str)
    for parts in (4, 7, 211):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sharding.external_shuffle(frame(spark, rows).repartition(parts), shards=3, bucket_rows=30).collect()
        assert len({r.shard for r in got}) == 3 and sorted((tuple(r) for r in got), key=str) == want
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_many_equal_rows_are_dealt_over_buckets(spark):
    rows = [(1, "same")] * 500 + [(i, "other") for i in range(2, 100)]
    got = sharding.external_shuffle(frame(spark, rows), shards=2, bucket_rows=50).collect()
    home = {r.shard for r in got if r.doc_id == 1}
    assert len(home) == 1 and Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    slots = sorted(r.slot for r in got if r.shard in home)
    assert slots == list(range(len(slots)))


def brute_windows(rows, size):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substrings(spark):
    passage, other = prose(1, 60), prose(2, 40)
    rows = [(i, f"{prose(100 + i, 30 + i)} {passage} {prose(200 + i, 25)}") for i in range(6)]
    rows += [(10, passage), (11, f"{passage} {passage}"), (12, other + "\u00a0x"), (13, f"a\x0bb {other}\n{prose(7, 9)}"), (14, "ha " * 200), (15, "ab cd " * 80 + prose(8, 30)), (16, None), (17, ""), (18, "short copy"), (19, "short copy"), (20, prose(9, 300)), (21, prose(9, 300)), (21, prose(9, 300)), (None, prose(9, 300)), (22, f"{other.split(' ', 3)[3]} tail {other}"), (23, prose(10, 20_000)), (24, " ".join(passage.split()[10:50]))]
    rows += [(30 + i, " ".join(prose(11, 200).split()[i * 7 : 120 + i * 5])) for i in range(10)]
    docs = frame(spark, rows).withColumns({"rid": F.lit(1), "marks": F.lit("x")})
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_windows_removed(docs).collect()]
    assert sorted(got, key=str) == brute_windows(rows, 35)
    assert substrings.repeated_windows_removed(frame(spark, [])).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6))
def test_substrings_on_few_words(spark, texts):
    rows = [(i, " ".join("abc"[x] for x in t)) for i, t in enumerate(texts)]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_windows_removed(frame(spark, rows), window=9, k=3).collect()]
    assert sorted(got, key=str) == brute_windows(rows, 9)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 12)) + 4 * rng.integers(0, 5, (1500, 1))
    x[200:420] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [1.0] * 3), (2004, [None] * 12), (None, [1.0] * 12), (7, x[7].tolist())]
    vectors = frame(spark, rows, "vec_id long, embedding array<double>").withColumns({"list": F.lit("clash"), "score": F.lit(1)})
    got = ann.search(vectors, F.col("vec_id") % 20 == 0, k=20, list_rows=150).toPandas()
    hits = total = 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        order = [int(i) for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine.score, s[mine.vec_id], rtol=1e-12)
        assert mine.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist() == mine.vec_id.tolist()
        hits += len({round(v, 9) for v in s[order]} & {round(v, 9) for v in mine.score})
        total += len({round(v, 9) for v in s[order]})
    assert hits / total > 0.95
    few = ann.search(frame(spark, rows[:5], "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=20)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2, 3, 4]
    assert ann.search(vectors.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("dimension", [64, 100])
def test_neighbours_among_equal_vectors(spark, dimension):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, dimension))
    x[rng.permutation(2000)[:500]] = x[3]
    x[rng.permutation(2000)[:40]] = 2.5 * x[3]
    vectors = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(vectors, F.col("vec_id") % 20 == 0, k=20, list_rows=300, recall=1.0, probe=1e300, beam=1 << 20).toPandas()
    for q in range(0, 2000, 20):
        s = np.cumsum(x * x[q], axis=1)[:, -1]
        order = [int(i) for i in np.lexsort((np.arange(2000), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == order and mine.score.tolist() == s[order].tolist()


def test_neighbours_among_many_lists(spark):
    x = np.random.default_rng(5).normal(size=(8000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    vectors = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(vectors, F.col("vec_id") % 40 == 0, k=20, list_rows=80).toPandas()  # 800 lists
    hits = 0
    for q in range(0, 8000, 40):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & set(got[got.query_id == q].vec_id))
    assert hits / (200 * 20) >= 0.9


def test_neighbours_in_lists_that_outgrow_their_number(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 24))
    x[100:700] = x[100]
    vectors = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(vectors, F.col("vec_id") % 60 == 0, k=20, list_rows=60, max_lists=12, bundle_rows=500).toPandas()
    hits = 0
    for q in range(0, 6000, 60):
        s = np.cumsum(x * x[q], axis=1)[:, -1]
        order = [int(i) for i in np.lexsort((np.arange(6000), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and mine.score.tolist() == s[mine.vec_id].tolist()
        hits += len(set(order) & set(mine.vec_id))
    assert hits / 2000 >= 0.9, hits / 2000


def test_neighbours_in_groups_of_their_own(spark):
    """Groups far from each other: no query is lost because the others of the table find theirs."""
    rng = np.random.default_rng(3)
    x = 5 * rng.normal(size=(60, 16))[rng.integers(0, 60, 9000)] + rng.normal(size=(9000, 16))
    vectors = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(vectors, F.col("vec_id") % 20 == 0, k=20, list_rows=100).toPandas()
    found = {q: set(f.vec_id) for q, f in got.groupby("query_id")}
    share = []
    for q in range(0, 9000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        share.append(len(set(np.argsort(-s)[:20].tolist()) & found.get(q, set())) / 20)
    assert np.mean(share) >= 0.95 and np.mean(np.array(share) < 0.75) <= 0.03, (np.mean(share), np.mean(np.array(share) < 0.75))


URLS = ["https://a.example.net/en/1", "http://EXAMPLE.net/en", "http://example.net/en/", "x://b.example.com/de/2?q", "http://example.com/de", "http://q.org/fr/9#t", "http://org/fr/", "http://forg/fr/", "http://a.net", "http://a.net/", "http://a.net?x", "nourl", None, "", "http://example.net.evil.io/en/", "a://b://c.net/z", "http://example.com:80/de/", "http://É.net/É"]


def test_urls(spark):
    rules = frame(spark, [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    pages = frame(spark, [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])], "page_id long, url string").withColumns({"rule": F.lit("clash"), "judged": F.lit(1), "u": F.lit(2)})
    got = urlfilter.judge_urls(pages, rules).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        u = r.url or ""
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u)
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(h + p, v) for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")) if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0 and urlfilter.judge_urls(pages, rules.limit(0)).where("rule is not null").count() == 0


def thue_morse(n, a, b):
    """n letters of a and b on which every polynomial hash modulo a power of two gives what it gives with a and b swapped."""
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_substrings_whose_hashes_collide(spark):
    left, right = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    head, tail, other = prose(21, 34), prose(22, 60), prose(23, 80)
    rows = [(1, f"{head} {left}"), (2, f"{head} {right}"), (3, f"{head} {left} {tail}"), (4, f"{head} {right} {tail}")]
    # on a nonbranching path of equal hashes: the words differ in the middle, and a part of it stands elsewhere
    rows += [(5, f"{other} {left} {tail}"), (6, f"{other} {right} {tail}"), (7, " ".join(other.split()[20:70]))]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_windows_removed(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_windows(rows, 35)
    two = frame(spark, rows[:2])
    assert [r.n_removed for r in substrings.repeated_windows_removed(two).collect()] == [0, 0]


def test_compaction(spark):
    chain = [(i, i, i + 1) for i in range(1, 40)] + [(100, 70, 71), (101, 72, 73), (200, 80, 81), (201, 81, 80)]
    got = {r.h: r.path for r in substrings.compacted(frame(spark, chain, "h long, l long, r long")).collect()}
    assert got == {**{i: 1 for i in range(1, 40)}, 100: 100, 101: 101}  # two nodes on a cycle have no path


def test_ties_and_long_hosts_of_urls(spark):
    rules = frame(spark, [("b.net", "/", "allow"), ("net", "/b/", "allow"), ("c.net", "/x", "allow"), ("c.net", "/x", "block"), ("e.net", "/ab", "block"), ("e.net", "/", "allow")], "host string, path string, verdict string")
    urls = ["http://b.net/b/", "http://c.net/x", "http://e.net/abc", "http://" + "a." * 20_000 + "net/b/1", "http://b.net"]
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(frame(spark, list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert got == {0: ("b.net/", "allow"), 1: ("c.net/x", "block"), 2: ("e.net/ab", "block"), 3: ("net/b/", "allow"), 4: (None, "allow")}
