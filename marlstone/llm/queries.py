"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm import ann, chat, decontaminate, langid, packing, pii, sharding, simhash, substrings, urlfilter
from marlstone.llm.common import shared_dir, table


def op1_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document: 3-word shingles, links at 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best match of every benchmark item in every document, up to a fifth of the item's words edited."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; the model sees only text and lang of rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a reply chain, formatted and read back; conversation -1 tests the escapes.

    Rows go by turn (ties by role, then text); rows with a null conv_id form
    one conversation.
    """
    extra = spark.sql("SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    at = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    rows = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "turn", "role", "text")
    messages = rows.select("tree", at.alias("id"), "role", "text").withColumns({"parent": F.when(F.col("id") > 1, F.col("id") - 1), "score": F.lit(0.0)})
    shown = chat.format_trees(messages)
    turns, loss = chat.turns_of(F.col("formatted")), chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    all_turns = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = shown.select("tree", F.size(turns).cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(F.expr("try_cast(tree AS BIGINT)").alias("conv_id"), "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), d AS (
  SELECT *, r = 'assistant' AS own,
    length(t) + length(regexp_replace(t, '[^\\\[<]', '', 'g')) AS shown,
    length(r) + length(regexp_replace(r, '[^\\\[<\n]', '', 'g')) AS shown_role
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE own), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, text) FILTER (WHERE own), '')) AS loss_sha256,
  CAST(sum(shown + CASE WHEN own THEN 7 ELSE 14 + shown_role END) AS BIGINT) AS formatted_chars
FROM d GROUP BY conv_id
"""


def op5_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the base spans, and all spans, of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op6_column_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


def op7_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40 and slot, by law key (rendezvous hashing of doc_id), read back from the shards written."""
    shuffled = sharding.external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=40)
    path = f"{shared_dir(spark)}/shards/{uuid.uuid4().hex}"
    sharding.write_shards(shuffled, path)
    done = sharding.read_shards(spark, path, shuffled.schema)
    return done.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", sharding.shard_of(F.col("doc_id"), 41, 20240607).alias("grown_shard"),
    )


def op8_debruijn_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left when repeated windows of 35 words are removed."""
    return substrings.repeated_windows_removed(table(spark, sf_dir, "documents"), window=35).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found, by inner product, of every embedding whose vec_id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: (host, path, verdict) of the rules that pages are judged by.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op10_url_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url; allow where no rule fits."""
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " AS r(host, path, verdict)")
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_bktree": op1_simhash_bktree,
        "op2_cgk_decontamination": op2_cgk_decontamination,
        "op3_crf_language_id": op3_crf_language_id,
        "op4_chat_trees": op4_chat_trees,
        "op5_skip_chain_pii": op5_skip_chain_pii,
        "op6_column_generation": op6_column_generation,
        "op7_two_pass_shuffle": op7_two_pass_shuffle,
        "op8_debruijn_substrings": op8_debruijn_substrings,
        "op9_posting_lists": op9_posting_lists,
        "op10_url_expressions": op10_url_expressions,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_trees": OP4_SQL, "op10_url_expressions": OP10_SQL}
