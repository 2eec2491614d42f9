"""SQL names for the functions that are not built in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> list[str]:
    """Register the engine's UDFs and table functions with a session; returns their names."""
    from marlstone.functions import fuzzy
    from marlstone.sources.ics import ExpandRule
    from marlstone.sources.markup import JsonLdEvents

    scalars = {"title_similarity": fuzzy.title_similarity, "address_similarity": fuzzy.address_similarity, "html_unescape": fuzzy.html_unescape, "nfkc": fuzzy.nfkc, "folded": fuzzy.folded}
    for name, f in scalars.items():
        spark.udf.register(name, f)
    tables = {"expand_rrule": ExpandRule, "jsonld_events": JsonLdEvents}
    for name, f in tables.items():
        spark.udtf.register(name, f)
    return [*scalars, *tables]
