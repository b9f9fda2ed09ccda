"""Sessions after late events: only those that a new event can change are cut again.

An event can extend, join or split nothing but the sessions that begin or end within the timeout of
it. These are found from one row for each session, by an equality join on (visitor, stretch of
time), so neither a busy visitor nor a long session is one task. Their stored events and the new
ones are sessionized by themselves: all others lie further away than the timeout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schema
from footfall.operators.sessions import sessionize
from footfall.operators.slices import SLICE

SESSION_DATE = "session_date"
#: What sessionizing adds to an event.
ADDED = ["session_started_at", "event_seq_in_session", "session_id", SLICE, SESSION_DATE]


def session_spans(stored: DataFrame) -> DataFrame:
    """One row per session of stored events: visitor, id, date, first and last time."""
    return stored.groupBy("session_id").agg(
        F.first("anonymous_id").alias("anonymous_id"),
        F.first(SESSION_DATE).alias(SESSION_DATE),
        F.first("session_started_at").alias("started"),
        F.max("occurred_at").alias("ended"),
    )


def touched_sessions(
    spans: DataFrame, fresh: DataFrame, timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES
) -> DataFrame:
    """The rows of `spans` with an event of `fresh` at most the timeout before, in or after them.

    Time is cut into stretches as long as the timeout. A session with its margins covers two or more
    of them; in those at its edges, the first or last event of the stretch decides.
    """
    timeout = timeout_minutes * 60_000_000

    def stretch(micros: Column) -> Column:
        return ((micros - F.pmod(micros, F.lit(timeout))) / timeout).cast("bigint")

    at = F.unix_micros("occurred_at")
    points = fresh.groupBy(F.col("anonymous_id").alias("_visitor"), stretch(at).alias("_at")).agg(
        F.min(at).alias("_first"), F.max(at).alias("_last")
    )
    low, high = fresh.agg(F.min("occurred_at"), F.max("occurred_at")).first()
    if low is None:
        return spans.limit(0)
    margin = F.expr(f"INTERVAL {timeout_minutes} MINUTES")
    near = (F.col("started") <= F.lit(high) + margin) & (F.col("ended") >= F.lit(low) - margin)
    # other visitors' sessions go before any row is multiplied
    seen = fresh.select(F.col("anonymous_id").alias("_visitor")).distinct()
    own = F.col("anonymous_id").eqNullSafe(F.col("_visitor"))
    begin, end = F.unix_micros("started") - timeout, F.unix_micros("ended") + timeout
    covered = (
        spans.where(near)
        .join(seen, own, "left_semi")
        .withColumns({"_begin": begin, "_end": end})
        .withColumn("_stretch", F.explode(F.sequence(stretch(begin), stretch(end))))
    )
    met = (
        own
        & (F.col("_stretch") == F.col("_at"))
        & (F.col("_last") >= F.col("_begin"))
        & (F.col("_first") <= F.col("_end"))
    )
    return covered.join(points, met, "left_semi").select(*spans.columns).distinct()


def recut(
    old: DataFrame, fresh: DataFrame, timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES
) -> DataFrame:
    """`old`, the stored events of all touched sessions, and `fresh` as sessions.

    `fresh` has the event columns of `old`; an event that is in both is taken once, from `old`.
    """
    names = [c for c in old.columns if c not in ADDED]
    new = fresh.select(*names).dropDuplicates(["event_id"])
    events = old.select(*names).unionByName(new.join(old, "event_id", "left_anti"))
    return dated(sessionize(events, timeout_minutes)).select(*names, *ADDED)


def dated(sessionized: DataFrame) -> DataFrame:
    """With the date of the session's start, by which they are stored."""
    return sessionized.withColumn(SESSION_DATE, F.to_date("session_started_at"))
