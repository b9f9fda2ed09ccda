"""A stored table of sessionized events that takes late events without being rebuilt."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall import schema
from footfall.operators import late
from footfall.operators.sessions import sessionize
from footfall.plans import warehouse
from footfall.session import stage


def store_sessions(
    events: DataFrame, name: str, timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES
) -> int:
    """Build the table from all events, partitioned by the date of the session's start."""
    rows = late.dated(sessionize(events, timeout_minutes))
    return warehouse.materialize_table(rows, name, partition_by=[late.SESSION_DATE])


def add_events(
    fresh: DataFrame,
    name: str,
    timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES,
    spans: DataFrame | None = None,
) -> int:
    """Bring the table to what a full rebuild with `fresh` would give; returns the events cut again.

    Only dates with a touched session are read with all columns and rewritten. `spans` are the rows
    of `late.session_spans`, by default taken from six columns of the table; who keeps one row for
    each session elsewhere can give them. The time and visitor of a stored event do not change:
    repeated events are ignored. The number `visitor_slice` tells slices apart inside one run only.
    """
    spark = fresh.sparkSession
    stored = spark.table(name)
    fresh = stage(fresh, "late_events")
    if fresh.isEmpty():
        return 0
    found = late.session_spans(stored) if spans is None else spans
    touched = stage(late.touched_sessions(found, fresh, timeout_minutes), "touched_sessions")
    old = warehouse.touched_partitions(stored, touched, late.SESSION_DATE).join(
        touched.select("session_id"), "session_id", "left_semi"
    )
    old = stage(old.select(*stored.columns), "touched_events")
    rows = stage(late.recut(old, fresh, timeout_minutes).select(*stored.columns), "recut_events")
    return warehouse.upsert(rows, name, ["event_id"], partition=late.SESSION_DATE, gone=old)
