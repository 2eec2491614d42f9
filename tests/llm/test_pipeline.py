"""The pipeline's stages on a small corpus with planted copies, leaks, personal data and odd rows."""

import numpy as np
import pytest

import corpus_pipeline

pytest.importorskip("public_tokenizers")
SYLLABLES = {"xx": ["ka", "to", "mi", "ren", "su"], "yy": ["sch", "ein", "ung", "ber", "ter"]}


def said(lang, seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(SYLLABLES[lang][i] for i in rng.integers(0, 5, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, said("xx" if i % 2 else "yy", i, 80), "xx" if i % 2 else "yy") for i in range(120)]
    near = rows[4][1].split()
    near[7] = "anders"
    items = [(k, said("xx", 900 + k, 25)) for k in range(3)]
    rows += [(200, rows[3][1], "xx"), (201, " ".join(near), "yy"), (202, f"{said('xx', 70, 20)} {items[1][1]} {said('xx', 71, 20)}", "xx"), (203, f"{said('yy', 72, 30)} mail a.b@mail.example.org now", "yy")]
    rows += [(204, None, "xx"), (205, "", None), (206, "12 34 ??", "yy"), (5, rows[5][1], "xx"), (5, rows[5][1], "xx"), (None, said("yy", 73, 60), None), (207, said("xx", 74, 8000), "xx"), (208, "qxz wvk jjq zzx qqv kxw vzq xjw qqq", None), (209, f"{said('xx', 75, 30)} {said('yy', 76, 30)}", None)]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or ""), 0.5, "own", 3) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, item int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*items, (9, None), (10, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus)
        assert docs.columns == columns, name
        docs = docs.cache()
        seen.append([r.doc_id for r in docs.collect()])
    language, near, clean, private = (sorted(x, key=lambda d: -1 if d is None else d) for x in seen)
    assert {204, 205, 206, 208}.isdisjoint(language) and len(language) == 133 - 4
    assert near == [None, *range(120), 202, 203, 207, 209]
    assert clean == [d for d in near if d != 202] and private == clean
    text = {r.doc_id: r for r in docs.collect()}
    assert text[203].text.endswith("mail [EMAIL] now") and text[203].n_chars == len(text[203].text) and text[203].score == 0.5 and text[203].spans == "own"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048 and packed.doc_id.nunique() == len(clean) - 1


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() > 120


def test_empty(spark, corpus, tmp_path):
    spark.read.parquet(f"{corpus}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
