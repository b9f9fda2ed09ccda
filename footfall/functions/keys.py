"""Surrogate keys: MD5 of a natural key, written as a UUID."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hyphenate(hex32: Column) -> Column:
    """32 hex digits as canonical 8-4-4-4-12 text; null stays null."""
    parts = [F.substring(hex32, start, size) for start, size in
             ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    dashed = [parts[0]]
    for part in parts[1:]:
        dashed += [F.lit("-"), part]
    return F.concat(*dashed)


def uuid_key(natural_key: Column | str) -> Column:
    col = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    return hyphenate(F.md5(col))


def session_id(visitor: Column, started_at: Column) -> Column:
    """Key of (visitor, start). Built from the start time and not from a counter,
    so older sessions that arrive later do not renumber the newer ones."""
    stamp = F.date_format(started_at, "yyyyMMddHHmmssSSS")
    return uuid_key(F.concat(visitor, F.lit("|"), stamp))
