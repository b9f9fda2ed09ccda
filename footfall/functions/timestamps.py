"""ISO-8601 text to UTC timestamps, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space beyond the blank, as a regular expression class.
SPACES = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# The usual form, which Spark's own cast reads; anything else takes the long way.
USUAL = (
    r"^(?!0000)\d{4}-\d\d-\d\d[T ]([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,6})?"
    r"(Z|[+-](0\d|1[0-3]):[0-5]\d)?$"
)

# Rewrites of other forms, one after the other, into the usual one. Any single
# character may separate date and time.
REWRITES = [
    # basic date and time: no separators
    (r"^(\d{4})(\d\d)(\d\d)(?=$|(?s:.)\d\d)", "$1-$2-$3"),
    (r"^(.{10}(?s:.)\d\d)([0-5]\d)(?=$|[+-]|[0-5]\d)(?:([0-5]\d)(?=$|[+-.,]))?", "$1:$2:$3"),
    # a date, or a time without minutes or seconds
    (r"^(\d{4}-\d\d-\d\d)$", "$1T00"),
    (r"^(.{10}(?s:.)\d\d)(?=$|[+-])", "$1:00"),
    (r"^(.{10}(?s:.)\d\d:\d\d):?(?=$|[+-])", "$1:00"),
    # a comma before the fraction; digits past the microseconds
    (r"^(.{19})[.,](\d{1,6})\d*(?=$|[+-])", "$1.$2"),
    # offset without separator or minutes
    (r"^(.{19,26}[+-]\d\d)(\d\d)$", "$1:$2"),
    (r"^(.{19,26}[+-]\d\d)$", "$1:00"),
    (r"(?s)^(.{10}).", "$1T"),
]
WEEK_DATE = r"^(\d{4})(-?)W(\d\d)(?:\2([1-7]))?"


def strip(text: Column) -> Column:
    """Without leading and trailing white space, Unicode's included.

    The text is searched only if its first or last character is a space.
    """
    edges = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    stripped = F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", "")
    return F.when(edges.rlike(SPACES), stripped).otherwise(text)


def is_blank(text: Column) -> Column:
    return text.rlike(f"^{SPACES}*$")


def parse_iso8601(text: Column) -> Column:
    """The instant as TIMESTAMP, null if `text` is not ISO-8601.

    Text without an offset is UTC; with one it is converted. Needs the session
    time zone to be UTC.
    """
    return F.when(text.rlike(USUAL), text.try_cast("timestamp")).otherwise(
        _other(F.regexp_replace(strip(text), "[Zz]$", "+00:00"))
    )


def _other(text: Column) -> Column:
    rewritten = F.when(text.rlike(WEEK_DATE), _week_to_date(text)).otherwise(text)
    for pattern, replacement in REWRITES:
        rewritten = F.regexp_replace(rewritten, pattern, replacement)
    # what is still not the usual form becomes empty, which casts to null
    return F.regexp_replace(rewritten, f"(?s)^(?!{USUAL[1:]}).*$", "").try_cast("timestamp")


def _week_to_date(text: Column) -> Column:
    """Text with its ISO week date written as a calendar date; null for no such week."""
    week = F.regexp_extract(text, WEEK_DATE, 3).try_cast("int")
    day = F.coalesce(F.regexp_extract(text, WEEK_DATE, 4).try_cast("int"), F.lit(1))
    january_4 = F.concat(F.substring(text, 1, 4), F.lit("-01-04")).try_cast("date")
    date = F.date_add(F.trunc(january_4, "WEEK"), (week - 1) * 7 + day - 1)
    rest = F.regexp_replace(text, WEEK_DATE, "")
    return F.when(F.weekofyear(date) == week, F.concat(date.cast("string"), rest))
