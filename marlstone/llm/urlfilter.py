"""URL filter: host-suffix and path-prefix expressions matched against rules by hash.

Each distinct URL is expanded into the expressions that a rule could name: every
suffix of its host of no more labels than some rule's, followed by every prefix of
its path that is as long as some rule's path. Expressions meet rules in an equi-join on the first
eight hex digits of a SHA-256 digest; the full digests then confirm the match,
and the longest rule wins. Built from DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import unique_name

#: Rules up to this number are broadcast (about 200 bytes each); beyond it the join shuffles.
BROADCAST_RULES = 50_000
SHORT = 8


def url_host(url: Column) -> Column:
    """What stands between the first :// and /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _expressions(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (null if none fits) and verdict added.

    rules: (host, path, verdict); a rule fits its host and all subdomains if
    the URL's path starts with the rule's. The longest host+path wins; of equal
    ones block, then the smaller text. Null URLs, and URLs without ://, have an
    empty host and path, so that only a rule with an empty host could fit; none
    does, and they get the default verdict. Repeated rows are all kept, rules
    with nulls are ignored, and columns of pages that are named like an added
    one are replaced.
    """
    named = rules.where("host is not null and path is not null and verdict is not null").select(F.concat("host", "path").alias("rule"), "host", "path", "verdict").distinct()
    lengths = [r[0] for r in named.select(F.length("path")).distinct().sort(F.length("path")).collect()]  # at most one per character of the longest path
    most_labels = named.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    digest = F.sha2(F.col("rule"), 256)
    keyed = named.select("rule", "verdict", digest.alias("rule_digest"), F.substring(digest, 1, SHORT).alias("short"))
    keyed = F.broadcast(keyed) if named.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else keyed
    urls = pages.select(F.col(url).alias("u")).where("u is not null").distinct()
    said = urls.select("u", F.explode(_expressions(url_host(F.col("u")), url_path(F.col("u")), lengths, most_labels)).alias("e")).select("u", F.sha2("e", 256).alias("digest"))
    met = said.withColumn("short", F.substring("digest", 1, SHORT)).join(keyed, "short").where("digest = rule_digest")
    order = F.struct(-F.length("rule"), (F.col("verdict") != "block").cast("int"), "rule")
    best = met.groupBy("u").agg(F.min_by(F.struct("rule", "verdict"), order).alias("best"))
    key, hit = unique_name(pages, "judged_url"), unique_name(pages, "judged")
    best = best.select(F.col("u").alias(key), F.col("best").alias(hit))
    joined = pages.drop("host", "path", "rule", "verdict").join(best, pages[url] == F.col(key), "left")
    return joined.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url)), "rule": F.col(f"{hit}.rule"), "verdict": F.coalesce(F.col(f"{hit}.verdict"), F.lit(default))}).drop(key, hit)
