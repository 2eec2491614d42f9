"""The category taxonomy: a nested JSON array as a lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHAPE = "array<struct<name:string,description:string,interests:array<struct<name:string,keywords:array<string>>>>>"


def keywords(documents: DataFrame, text: Column) -> DataFrame:
    """(category, interest, keyword), lower-cased keywords once each; unreadable documents and empty lists give none."""
    categories = documents.select(F.explode(F.from_json(text, SHAPE)).alias("c"))
    interests = categories.select(F.col("c.name").alias("category"), F.explode("c.interests").alias("i"))
    return interests.select("category", F.col("i.name").alias("interest"), F.explode("i.keywords").alias("k")).select("category", "interest", F.lower(F.trim("k")).alias("keyword")).distinct()
