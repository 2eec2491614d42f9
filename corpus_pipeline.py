"""The training-corpus pipeline: STAGES over documents, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import decontaminate, langid, packing, pii, simhash
from marlstone.llm.common import saved, table, unique_name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the learned languages, code-switched ones included.

    Those without a letter go, and those of whose letter trigrams too many are
    in no labelled document (langid's calibrated share): gibberish, other scripts,
    languages that no label names. So null and empty texts go, repeated rows stay,
    and further columns of any name stay as they are.
    """
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    held = {c: unique_name(docs, f"own_{c}") for c in docs.columns if c.lower() in langid.ADDED}
    said = langid.identify(docs.withColumnsRenamed(held), model)
    kept = said.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("known") >= model.least))
    return kept.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the smallest doc_id: five-word shingles, similarity 0.8 or more.

    Repeated rows and null texts are copies; rows with a null doc_id come last in their group.
    """
    return simhash.deduplicated(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edits in up to a fifth of its words included.

    Null and empty texts and rows with a null doc_id stay; null and empty items match nothing.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced by its kind; n_chars follows the text, and null texts stay null."""
    done = pii.redact(docs, pii.fit(docs.select("doc_id", "text")))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents in training sequences of at most 2048 ids; null and empty texts have the one id that ends a document."""
    return packing.pack(docs, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sequences", sequences),
]

#: Fitted models and iterative graph steps decide here, which SQL cannot express; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
