"""Event identity and change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions.text import clean, normalize_title

#: Fixed values of the identity: hex digits kept, separator and description characters of the content hash.
UID_HEX, FIELD_SEPARATOR, HASHED_DESCRIPTION = 16, "\x1f", 2000
STAMP = "yyyyMMdd'T'HHmmss'Z'"


def stamp(c: Column) -> Column:
    return F.date_format(c, STAMP)


def make_uid(space: Column, source_uid: Column, start: Column, title: Column, recurring: Column) -> Column:
    """space:uid, with the start for a series; without a source uid a hash of space, start and title."""
    key = clean(source_uid)
    hashed = F.substring(F.sha1(F.concat(space, stamp(start), normalize_title(title))), 1, UID_HEX)
    named = F.when(F.coalesce(recurring, F.lit(False)), F.concat(space, F.lit(":"), key, F.lit(":"), stamp(start))).otherwise(F.concat(space, F.lit(":"), key))
    return F.when(key.isNotNull(), named).otherwise(hashed)


def content_hash(title: Column, start: Column, end: Column, location: Column, address: Column, url: Column, description: Column) -> Column:
    empty = lambda c: F.coalesce(c, F.lit(""))
    parts = [empty(title), empty(stamp(start)), empty(stamp(end)), empty(location), empty(address), empty(url), F.substring(empty(description), 1, HASHED_DESCRIPTION)]
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *parts), 256)


def source_key(space: Column, label: Column) -> Column:
    return F.concat(space, F.lit(":"), label)
