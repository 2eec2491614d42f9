"""The registered queries over a small folder of tables, against brute force or their SQL."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_llm_operators import brute_fingerprint, brute_pii, brute_windows, language_text, personal, prose

from marlstone.llm import pii, queries

QUERIES = queries.queries()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    base = prose(1, 120)
    docs = [(i, f"{language_text(lang, i, 40)} {personal(i)[i % 4][1]} {language_text(lang, i + 500, 20)}", lang) for i in range(120) for lang in ("xx", "yy", "zz")[i % 3 : i % 3 + 1]]
    docs += [(200, base, "xx"), (201, base, "xx"), (202, base.replace("w7", "x", 1), None), (203, None, "yy"), (204, "", None), (205, " \t\x0b", "zz"), (206, f"{prose(3, 40)} {' '.join(base.split()[20:80])} {prose(4, 10)}", None), (207, "123 !?", None)]
    docs += [(208, "漢字 " * 400 + "é@x.org a.b@mail.example.com, 10.0.0.255 and 4111 1111 1111 1111 +1 (269) 555-1234", None), (209, " " * 9000 + "gap", "yy"), (210, prose(5, 5000), "xx"), (211, "a<|endoftext|>b", None)]
    items = [(i, prose(700 + i, 20 + i)) for i in range(4)]
    docs += [(300 + i, f"{prose(800 + i, 12)} {text} {prose(900 + i, 12)}", "xx") for i, text in items]
    rows = [(d, t, lang, f"src{d % 3}", len(t or "")) for d, t, lang in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    talks = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c} [/INST]</s>\\e" if (c + t) % 5 else None) for c in range(12) for t in range(c + 1)]
    talks += [(None, 0, "user", "nobody's"), (50, 0, "assistant", "first"), (50, 1, None, "x"), (50, 2, "sys\ntem", "ré[")]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    x = np.random.default_rng(3).normal(size=(400, 16))
    x[50:90] = x[50]
    vectors = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(400, None, 0), (420, [0.0] * 16, 0), (440, [float("inf")] * 16, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").write.parquet(f"{folder}/embeddings.parquet")
    urls = ["https://a.Example.net/en/1", "http://example.net/x?q#f", "x://b.example.com/de/2?q", "http://q.org/fr/9#t", "http://org/fr", "nourl", None, "", "a://b://c.net/z", "http://a.net?x"]
    spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder, [(d, t) for d, t, _ in docs], talks, x


def by_sql(folder, sql):
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return sorted(map(str, con.execute(sql).fetchall())), [c[0] for c in con.description]


def test_op1(spark, tables):
    folder, docs, _, _ = tables
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_bktree"](spark, folder).collect()}
    prints = [brute_fingerprint(t) for _, t in docs]
    label = {d: d for d, _ in docs}
    for _ in docs:
        for (a, _), fa in zip(docs, prints, strict=True):
            for (b, _), fb in zip(docs, prints, strict=True):
                if (fa ^ fb).bit_count() <= 3:
                    label[a] = min(label[a], label[b])
        if all(label[label[d]] == label[d] for d, _ in docs):
            break
    assert got == {d: (f"{f:016x}", label[d]) for (d, _), f in zip(docs, prints, strict=True)}


def test_op2(spark, tables):
    folder, *_ = tables
    found = {(r.doc_id, r.item_id, r.distance) for r in QUERIES["op2_cgk_decontamination"](spark, folder).collect()}
    assert {(300 + i, i, 0) for i in range(4)} <= found and all(d - 300 == i for d, i, _ in found)


def test_op3(spark, tables):
    folder, docs, _, _ = tables
    got = QUERIES["op3_crf_language_id"](spark, folder).collect()
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    said = {r.doc_id: r.lang_pred for r in got}
    assert all(said[d] == "und" for d in (203, 204, 205, 207)) and set(said.values()) <= {"xx", "yy", "zz", "und"}
    assert sum(said[i] == ("xx", "yy", "zz")[i % 3] for i in range(120)) >= 118


def test_op4(spark, tables):
    folder, _, talks, _ = tables
    df = QUERIES["op4_chat_trees"](spark, folder)
    want, columns = by_sql(folder, queries.OP4_SQL)
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == want
    turns = [(c, t, r or "", x or "") for c, t, r, x in talks] + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    for r in df.collect():
        own = sorted((t, role, x) for c, t, role, x in turns if c == r.conv_id)
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in own).encode()).hexdigest()
        loss = "".join(x for _, role, x in own if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_op5(spark, tables):
    folder, docs, _, _ = tables
    texts = dict(docs)
    got = QUERIES["op5_skip_chain_pii"](spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        base = brute_pii(texts[r.doc_id] or "")
        counts = Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in range(4))
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = [(pii.KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(base) <= set(spans) and spans == sorted(spans)


def test_op6(spark, tables):
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    folder, docs, _, _ = tables
    got = QUERIES["op6_column_generation"](spark, folder).toPandas()
    for d, text in docs:
        ids = np.array(full.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        mine = got[got.doc_id == d].sort_values("start")
        assert mine.start.tolist() == list(range(0, len(ids), 2048)) and (mine.doc_tokens == len(ids)).all() and mine.length.sum() == len(ids)
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[a : a + 2048].tobytes()) for a in range(0, len(ids), 2048)]
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.length.sum() <= 2048 and (part.length.cumsum() - part.length).tolist() == part.offset.tolist()


def test_op7(spark, tables):
    folder, docs, _, _ = tables
    texts = dict(docs)
    got = QUERIES["op7_two_pass_shuffle"](spark, folder).toPandas()
    assert sorted(got.doc_id) == sorted(d for d, _ in docs) and set(got.law) == {"key"} and got.shard.between(0, 39).all()
    for r in got.itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw)) and r.grown_shard in (r.shard, 40)
    assert (got.grown_shard == 40).any()
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in got.groupby("shard"))


def test_op8(spark, tables):
    folder, docs, _, _ = tables
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_debruijn_substrings"](spark, folder).collect()]
    assert sorted(got, key=str) == brute_windows(docs, 35)


def test_op9(spark, tables):
    folder, _, _, x = tables
    got = QUERIES["op9_posting_lists"](spark, folder).toPandas()
    hits = 0
    for q in range(0, 400, 20):
        s = np.cumsum(x * x[q], axis=1)[:, -1]
        order = [int(i) for i in np.lexsort((np.arange(400), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and mine.score.tolist() == s[mine.vec_id].tolist()
        assert mine.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist() == mine.vec_id.tolist()
        hits += len(set(order) & set(mine.vec_id))
    assert hits / 400 >= 0.9 and got.query_id.nunique() == 20


def test_op10(spark, tables):
    folder, *_ = tables
    want, columns = by_sql(folder, queries.OP10_SQL)
    assert sorted(str(tuple(r[c] for c in columns)) for r in QUERIES["op10_url_expressions"](spark, folder).collect()) == want
