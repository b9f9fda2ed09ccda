"""One row per page view, with its place in the session and its dwell time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.keys import uuid_key
from footfall.functions.rounding import seconds_between
from footfall.operators.slices import SLICE

SO_FAR = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def fct_page_views(sessionized: DataFrame) -> DataFrame:
    """Page views numbered within their session.

    `seconds_on_page` is the time to the next page view of the session; the last
    one has no next, so it is the exit page and its dwell time is null, not zero.

    Page views are numbered in the partitioning and order that `sessionize` left. Only
    those of visitors cut into slices are looked at again, for what a slice leaves open.
    """
    views = sessionized.where((F.col("event_name") == "page_view") & F.col("page_path").isNotNull())
    in_order = Window.partitionBy("anonymous_id", SLICE).orderBy("occurred_at", "event_id")
    following = F.lead(F.struct("session_id", "occurred_at")).over(in_order)
    views = views.withColumns(
        {
            "_row": F.row_number().over(in_order),
            "_starts": ~F.col("session_id").eqNullSafe(F.lag("session_id").over(in_order)),
            "_next": F.when(following["session_id"] == F.col("session_id"), following["occurred_at"]),
        }
    )
    first_row = F.last(F.when(F.col("_starts"), F.col("_row")), ignorenulls=True)
    views = views.withColumn(
        "_seq", F.col("_row") - first_row.over(in_order.rowsBetween(*SO_FAR)) + 1
    )

    cut = views.where(F.col(SLICE).isNotNull())
    # at most a row for each slice
    joined = views.join(F.broadcast(_across_slices(cut)), ["anonymous_id", SLICE], "left")
    seq = F.col("_seq") + F.when(
        F.col("session_id") == F.col("_head"), F.col("_views_before")
    ).otherwise(F.lit(0))
    next_at = F.coalesce(
        "_next", F.when(F.col("session_id") == F.col("_tail"), F.col("_next_slice_at"))
    )
    return joined.select(
        F.col("event_id").alias("page_view_id"),
        "session_id",
        "anonymous_id",
        uuid_key("anonymous_id").alias("visitor_key"),
        uuid_key("page_path").alias("page_key"),
        "user_id",
        "occurred_at",
        F.to_date("occurred_at").alias("view_date"),
        seq.cast("bigint").alias("page_view_seq"),
        "page_path",
        "page_title",
        "page_type",
        "referrer",
        "device_type",
        "browser",
        "os",
        "country",
        (seq == 1).alias("is_entry_page"),
        next_at.isNull().alias("is_exit_page"),
        seconds_between(next_at, F.col("occurred_at")).alias("seconds_on_page"),
    )


def _across_slices(views: DataFrame) -> DataFrame:
    """Per slice: the session it continues and the views that one had before, and
    the session it leaves open and when that one's next view follows."""
    parts = views.groupBy("anonymous_id", SLICE, "session_id").agg(
        F.count("*").alias("views"), F.min("occurred_at").alias("first_at")
    )
    by_slice = Window.partitionBy("anonymous_id", "session_id").orderBy(SLICE)
    parts = parts.withColumns(
        {
            "before": F.sum("views").over(by_slice.rowsBetween(*BEFORE)),
            "next_at": F.lead("first_at").over(by_slice),
        }
    )
    # Sessions follow one another, so a slice has at most one of each.
    return parts.groupBy("anonymous_id", SLICE).agg(
        F.max(F.when(F.col("before").isNotNull(), F.col("session_id"))).alias("_head"),
        F.max("before").alias("_views_before"),
        F.max(F.when(F.col("next_at").isNotNull(), F.col("session_id"))).alias("_tail"),
        F.max("next_at").alias("_next_slice_at"),
    )
