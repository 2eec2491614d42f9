"""Events as JSON texts and back, for whoever reads state without Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}


def encoded(*columns: str | Column) -> Column:
    """One JSON object of the columns, nulls included."""
    return F.to_json(F.struct(*columns), OPTIONS)


def decoded(texts: DataFrame, text: Column, schema: StructType) -> DataFrame:
    """The rows that texts hold, in schema's columns; a text that is no object of it is a row of nulls."""
    return texts.select(F.from_json(text, schema, OPTIONS).alias("r")).select("r.*")
