"""Text columns: cleaning, titles, truncation, prices, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE_LIMIT = 200
BARE_URL = r"(?i)^(https?://|www\.)\S*$"


def trimmed(c: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Trimmed; blank becomes null."""
    return F.nullif(trimmed(c), F.lit(""))


def compatible(c: Column) -> Column:
    """NFKC; ASCII text is its own form and stays in the JVM."""
    from marlstone.functions.fuzzy import nfkc

    other = c.rlike(r"[^\x00-\x7F]")
    return F.when(other, nfkc(F.when(other, c))).otherwise(c)


def normalize_title(c: Column) -> Column:
    """Compatibility forms folded, all but letters and numbers to spaces, white space collapsed, lower case; null becomes empty."""
    spaced = F.regexp_replace(F.regexp_replace(compatible(c), r"[^\p{L}\p{N}\s]", " "), r"(?U)\s+", " ")
    return F.coalesce(F.lower(F.trim(spaced)), F.lit(""))


def is_bare_url(c: Column) -> Column:
    return trimmed(c).rlike(BARE_URL)


def location_state(c: Column) -> Column:
    """present, empty or url_only."""
    text = F.coalesce(trimmed(c), F.lit(""))
    return F.when(text == "", "empty").when(text.rlike(BARE_URL), "url_only").otherwise("present")


def truncated(c: Column, limit: int) -> Column:
    """At most limit characters, cut at the last blank before, with an ellipsis; line ends unified."""
    text = trimmed(F.regexp_replace(F.regexp_replace(c, "\r\n", "\n"), "\r", "\n"))
    head = F.substring(text, 1, limit + 1)
    at_blank = F.regexp_extract(head, r"(?s)^(.*)[ \n\t]", 1)
    cut = F.when(at_blank != "", at_blank).otherwise(F.substring(text, 1, limit))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.regexp_replace(cut, r"(?U)\s+$", ""), F.lit("…")))


def strip_tags(c: Column) -> Column:
    """Tags to spaces, white space collapsed; entities are left to html_unescape."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"(?U)\s+", " "))


def money(c: Column, symbol: str = "$") -> Column:
    """$1,234.50; null stays null, zero is Free."""
    return F.when(c == 0, F.lit("Free")).otherwise(F.concat(F.lit(symbol), F.format_number(c, 2)))


def minor_unit_price(low: Column, high: Column, digits: Column, symbol: str = "$") -> Column:
    """A price or range from amounts in minor units."""
    shown = lambda c: F.concat(F.lit(symbol), F.format_number(c.cast("decimal(20,4)") / F.pow(F.lit(10), digits).cast("decimal(20,4)"), 2))
    return F.when(low.isNull(), None).when(high.isNull() | (high == low), F.when(low == 0, F.lit("Free")).otherwise(shown(low))).otherwise(F.concat(shown(low), F.lit(" - "), shown(high)))


def ordered_distinct(c: Column) -> Column:
    """Trimmed, non-blank values of an array, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(c, trimmed), lambda x: x.isNotNull() & (x != "")))


def url_host(c: Column) -> Column:
    return F.lower(F.try_parse_url(c, F.lit("HOST")))


def url_origin(c: Column) -> Column:
    """scheme://host[:port], lower-cased."""
    return F.nullif(F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#@]+)", 1)), F.lit(""))


def same_host(a: Column, b: Column) -> Column:
    return F.coalesce(url_host(a) == url_host(b), F.lit(False))


def url_joined(base: Column, link: Column) -> Column:
    """link as seen from the page base: absolute as it is, //host with the scheme, /path with the origin, ?query and relative paths beside the page."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    bare = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(bare.rlike(r"^[^:]+://[^/]*$"), F.concat(bare, F.lit("/"))).otherwise(F.regexp_extract(bare, r"^(.*/)", 1))
    root = F.regexp_extract(base, r"^([^:]+://[^/?#]+)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(bare, link)).otherwise(F.concat(folder, link))
    )


def url_slug(c: Column) -> Column:
    """The last part of a URL's path; null if there is none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(F.try_parse_url(c, F.lit("PATH")), r"/+$", ""), r"([^/]+)$", 1), F.lit(""))


def permissive_number(c: Column, kind: str = "bigint") -> Column:
    """A whole or decimal number written as text, else null; blank is null."""
    text = trimmed(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$" if kind == "bigint" else r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), text.try_cast(kind))


def content_type(header: Column) -> Column:
    return F.lower(F.trim(F.substring_index(header, ";", 1)))


def content_type_matches(actual: Column, expected: Column) -> Column:
    """Equal, type/* wildcard, or a +json / +xml suffix of the expected subtype."""
    major, minor = F.substring_index(expected, "/", 1), F.substring_index(expected, "/", -1)
    wild = (minor == "*") & actual.startswith(F.concat(major, F.lit("/")))
    return F.coalesce((actual == expected) | wild | actual.endswith(F.concat(F.lit("+"), minor)), F.lit(False))


def permissive_bool(c: Column) -> Column:
    low = F.lower(trimmed(c.cast("string")))
    return F.when(low.isin("true", "yes", "1", "y", "on"), True).when(low.isin("false", "no", "0", "n", "off"), False)
