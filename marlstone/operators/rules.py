"""The declarative filter cascade and its zero-filled tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.fuzzy import match_forms, match_forms_of_each
from marlstone.functions.text import location_state

RULES = ("title_excludes", "location_excludes", "categories_exclude", "title_contains", "location_contains")
#: A source whose filters drop this share of at least so many events is suspicious.
LOUD_SHARE, LOUD_EVENTS = 0.9, 5
NONE = "array<string>"


def meets(text_forms: Column, pattern_forms: Column) -> Column:
    """Whether a pattern is part of a text, in any of the forms of either (fuzzy.forms)."""
    return F.exists(text_forms, lambda t: F.exists(pattern_forms, lambda p: F.contains(t, p)))


def matching(text: Column, text_forms: Column, patterns: Column, pattern_forms: Column) -> Column:
    """The patterns found in text, in order: case and entities don't count; empty texts and patterns never match."""
    each = F.filter(F.coalesce(patterns, F.array().cast(NONE)), lambda p, i: (p != "") & meets(text_forms, F.get(pattern_forms, i)))
    return F.when(F.coalesce(text, F.lit("")) != "", each).otherwise(F.array().cast(NONE))


def matching_categories(categories: Column, category_forms: Column, patterns: Column, pattern_forms: Column) -> Column:
    known = F.coalesce(categories, F.array().cast(NONE))
    return F.flatten(F.transform(known, lambda c, i: matching(c, F.get(category_forms, i), patterns, pattern_forms)))


def pattern_forms(filters: Column) -> Column:
    """struct by rule of the forms of its patterns; computed on the registry's rows, once a source."""
    return F.struct(*[match_forms_of_each(filters[r]).alias(r) for r in RULES])


def judged(events: DataFrame, filters: Column | None = None, forms: Column | None = None) -> DataFrame:
    """events with rule, pattern (of the drop; null if kept), hits (rule, pattern) and kept_on_missing_location added.

    filters: the struct of schemas.SOURCES, forms: their pattern_forms; the first
    rule of the cascade that drops an event owns the drop.
    """
    f = filters if filters is not None else F.col("filters")
    wanted = lambda name: F.coalesce(F.size(f[name]), F.lit(0)) > 0
    state = location_state(F.col("location_name"))
    out = events.withColumns({"_forms": forms if forms is not None else pattern_forms(f), "_t": match_forms("title"), "_l": match_forms("location_name"), "_c": match_forms_of_each("categories")})
    found = lambda text, own, rule: matching(F.col(text), F.col(own), f[rule], F.col(f"_forms.{rule}"))
    out = out.withColumns({
        "_te": found("title", "_t", "title_excludes"),
        "_le": F.when(state == "present", found("location_name", "_l", "location_excludes")).otherwise(F.array().cast(NONE)),
        "_ce": matching_categories(F.col("categories"), F.col("_c"), f["categories_exclude"], F.col("_forms.categories_exclude")),
        "_tc": found("title", "_t", "title_contains"),
        "_lc": found("location_name", "_l", "location_contains"),
        "_missing": state != "present",
    })
    some = lambda c: F.size(c) > 0
    no_title = wanted("title_contains") & ~some("_tc")
    lacking = wanted("location_contains") & F.col("_missing")
    no_place = wanted("location_contains") & ~F.col("_missing") & ~some("_lc")
    allowed = F.coalesce(f["location_allow_when_missing"], F.lit(True))
    rule = (
        F.when(some("_te"), "title_excludes").when(some("_le"), "location_excludes").when(some("_ce"), "categories_exclude")
        .when(no_title, "title_contains").when(lacking & ~allowed, "location_missing").when(no_place, "location_contains")
    )
    first = lambda c: F.try_element_at(c, F.lit(1))
    out = out.withColumn("rule", rule)
    owner = F.col("rule")
    credit = lambda name, hits, when: F.when(when, F.transform(hits, lambda p: F.struct(F.lit(name).alias("rule"), p.alias("pattern")))).otherwise(F.array().cast("array<struct<rule:string,pattern:string>>"))
    passed = owner.isNull() | owner.isin("title_contains", "location_missing", "location_contains")
    later = owner.isNull() | owner.isin("location_missing", "location_contains")
    hits = F.concat(
        credit("title_excludes", F.col("_te"), owner == "title_excludes"), credit("location_excludes", F.col("_le"), owner == "location_excludes"), credit("categories_exclude", F.col("_ce"), owner == "categories_exclude"),
        credit("title_contains", F.col("_tc"), passed & later & wanted("title_contains")), credit("location_contains", F.col("_lc"), owner.isNull() & wanted("location_contains") & ~F.col("_missing")),
    )
    pattern = F.when(owner == "title_excludes", first("_te")).when(owner == "location_excludes", first("_le")).when(owner == "categories_exclude", first("_ce"))
    return out.withColumns({"pattern": pattern, "hits": hits, "kept_on_missing_location": owner.isNull() & lacking}).drop("_te", "_le", "_ce", "_tc", "_lc", "_missing", "_forms", "_t", "_l", "_c")


def apply_filters(events: DataFrame, sources: DataFrame) -> DataFrame:
    """Events of every source judged by that source's filters; sources is the registry and is broadcast."""
    known = sources.select("space_id", "source_label", "filters").withColumn("_known", pattern_forms(F.col("filters")))
    joined = events.join(F.broadcast(known), ["space_id", "source_label"], "left")
    return judged(joined, forms=F.col("_known")).drop("_known")


def drop_tallies(judged_events: DataFrame, sources: DataFrame) -> DataFrame:
    """(space_id, source_label, rule, drops): zero for every configured rule that dropped nothing."""
    f = F.col("filters")
    domain = sources.select("space_id", "source_label", F.explode(F.array_compact(F.array(*[F.when(F.size(f[r]) > 0, F.lit(r)) for r in RULES], F.when(F.size(f["location_contains"]) > 0, F.lit("location_missing"))))).alias("rule"))
    counts = judged_events.where("rule is not null").groupBy("space_id", "source_label", "rule").agg(F.count("*").alias("drops"))
    return domain.join(counts, ["space_id", "source_label", "rule"], "left").na.fill(0, ["drops"])


def pattern_tallies(judged_events: DataFrame, sources: DataFrame) -> DataFrame:
    """(space_id, source_label, rule, pattern, hits), zero-filled; a pattern with no hit is dead."""
    f = F.col("filters")
    paired = lambda r: F.transform(F.coalesce(f[r], F.array().cast("array<string>")), lambda p: F.struct(F.lit(r).alias("rule"), p.alias("pattern")))
    pairs = F.flatten(F.array(*[paired(r) for r in RULES]))
    domain = sources.select("space_id", "source_label", F.explode(pairs).alias("p")).select("space_id", "source_label", "p.rule", "p.pattern").distinct()
    counts = judged_events.select("space_id", "source_label", F.explode("hits").alias("h")).groupBy("space_id", "source_label", "h.rule", "h.pattern").agg(F.count("*").alias("hits"))
    return domain.join(counts, ["space_id", "source_label", "rule", "pattern"], "left").na.fill(0, ["hits"])


def kept_without_place(judged_events: DataFrame) -> DataFrame:
    """(space_id, source_label, kept_on_missing_location): events kept although a location was asked for and they have none."""
    return judged_events.groupBy("space_id", "source_label").agg(F.count_if("kept_on_missing_location").alias("kept_on_missing_location"))


def loud_sources(judged_events: DataFrame) -> DataFrame:
    """(space_id, source_label, total, dropped, drop_rate, loud)."""
    out = judged_events.groupBy("space_id", "source_label").agg(F.count("*").alias("total"), F.count_if(F.col("rule").isNotNull()).alias("dropped"))
    out = out.withColumn("drop_rate", F.col("dropped") / F.col("total"))
    return out.withColumn("loud", (F.col("total") >= LOUD_EVENTS) & (F.col("drop_rate") >= LOUD_SHARE))
