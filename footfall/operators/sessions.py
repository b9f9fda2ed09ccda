"""Sessions by inactivity gap, and one row per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall import schema
from footfall.functions.channels import channel
from footfall.functions.keys import session_id, uuid_key
from footfall.functions.rounding import seconds_between
from footfall.operators.slices import SLICE, add_slices

SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def sessionize(
    events: DataFrame,
    timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES,
    visitor: str = "anonymous_id",
    ts: str = "occurred_at",
    tie: str = "event_id",
    parts: int | None = None,
) -> DataFrame:
    """`events` plus session_id, session_started_at and event_seq_in_session.

    A session starts at a visitor's first event, or when more than
    `timeout_minutes` passed since the previous one; a gap of exactly the timeout
    continues it. `tie` orders events of the same time.

    All columns are kept, so later steps need no join back to the events. The rows
    are shuffled once by (visitor, slice) and sorted once; `parts` is the number of
    parts of which no visitor's slice is much larger than one. Only visitors cut into
    slices are stitched, from a row for each slice.
    """
    if timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be positive")
    timeout = F.lit(timeout_minutes * 60_000_000)

    numbered = _local_sessions(
        add_slices(events, visitor, ts, tie, parts), timeout, visitor, ts, tie
    )
    cut = numbered.where(F.col(SLICE).isNotNull())
    carry = _carried_sessions(cut, timeout, visitor, ts)  # at most a row for each cut

    joined = numbered.join(F.broadcast(carry), [visitor, SLICE], "left")
    # Only a slice's first session can belong to the slice before.
    continued = (F.col("_local.row") == 1) & F.col("_carry_start").isNotNull()
    started = F.when(continued, F.col("_carry_start")).otherwise(F.col("_local.at"))
    seq = F.col("_row") - F.col("_local.row") + 1
    seq = F.when(continued, seq + F.col("_carry_events")).otherwise(seq)
    return joined.select(
        *events.columns,
        started.alias("session_started_at"),
        seq.cast("bigint").alias("event_seq_in_session"),
        session_id(F.col(visitor), started).alias("session_id"),
        SLICE,
    )


def _gap(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def _local_sessions(
    events: DataFrame, timeout: Column, visitor: str, ts: str, tie: str
) -> DataFrame:
    """Row number in the slice, and time and row number of the session's first event."""
    in_order = Window.partitionBy(visitor, SLICE).orderBy(ts, tie)
    before = F.lag(ts).over(in_order)
    rows = events.withColumns(
        {
            "_row": F.row_number().over(in_order),
            "_starts": before.isNull() | (_gap(F.col(ts), before) > timeout),
        }
    )
    start = F.when(F.col("_starts"), F.struct(F.col(ts).alias("at"), F.col("_row").alias("row")))
    return rows.withColumn(
        "_local", F.last(start, ignorenulls=True).over(in_order.rowsBetween(*SO_FAR))
    ).drop("_starts")


def _carried_sessions(numbered: DataFrame, timeout: Column, visitor: str, ts: str) -> DataFrame:
    """Per slice that continues an open session: its start and its events so far."""
    last = F.max(F.struct("_row", F.col("_local.at").alias("at"), F.col("_local.row").alias("row")))
    slices = numbered.groupBy(visitor, SLICE).agg(
        F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), last.alias("tail")
    )
    by_time = Window.partitionBy(visitor).orderBy(SLICE)
    before = F.lag("last_at").over(by_time)
    slices = slices.withColumn(
        "fresh", before.isNull() | (_gap(F.col("first_at"), before) > timeout)
    )
    # The session left open at the end of each slice, and its events up to there.
    opened = F.when(F.col("fresh") | (F.col("tail.row") > 1), F.col("tail.at"))
    slices = slices.withColumn(
        "open_at", F.last(opened, ignorenulls=True).over(by_time.rowsBetween(*SO_FAR))
    )
    by_open = Window.partitionBy(visitor, "open_at").orderBy(SLICE).rowsBetween(*SO_FAR)
    tail_events = (F.col("tail._row") - F.col("tail.row") + 1).cast("bigint")
    slices = slices.withColumn("open_events", F.sum(tail_events).over(by_open))
    return (
        slices.withColumn("_carry_start", F.lag("open_at").over(by_time))
        .withColumn("_carry_events", F.lag("open_events").over(by_time))
        .where(~F.col("fresh"))
        .select(visitor, SLICE, "_carry_start", "_carry_events")
    )


def bridge(sessionized: DataFrame) -> DataFrame:
    """The narrow event -> session relation: one row per event."""
    return sessionized.select(
        "event_id",
        "anonymous_id",
        "occurred_at",
        "session_started_at",
        "event_seq_in_session",
        "session_id",
    )


def bridge_join(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Events with the session columns of a stored bridge."""
    return events.join(
        bridge.select("event_id", "session_id", "session_started_at", "event_seq_in_session"),
        "event_id",
    )


def step_time_columns(steps: list[str]) -> dict[str, Column]:
    """Aggregates giving the first time of each step, under _step_1, _step_2, ..."""
    return {
        f"_step_{i}": F.min(F.when(F.col("event_name") == step, F.col("occurred_at")))
        for i, step in enumerate(steps, start=1)
    }


def is_bounce(
    page_views: Column, viewed: Column, added: Column, checkout: Column, purchased: Column
) -> Column:
    """At most one page view and no funnel action; searches do not count."""
    return (page_views <= 1) & ~viewed & ~added & ~checkout & ~purchased


FIRST_EVENT = ["device_type", "browser", "os", "country", "utm_source", "utm_medium", "utm_campaign"]


def fct_sessions(sessionized: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """One row per session: counts, funnel flags, revenue, first-event attributes.

    With `steps`, also `step_times`: the first time of each step in the session,
    null where it did not happen, for `funnel.funnel_steps`.

    The order that `sessionize` left is used: running values at the last event of a session tell
    all about it, so events are neither sorted nor shuffled again, one row per session goes on.
    Distinct values are counted over distinct (session, kind, value) rows, so no session is held
    as a set.
    """
    steps = steps or []
    parts = _session_parts(sessionized, steps)

    def sums(*names: str) -> list[Column]:
        return [F.sum(name).alias(name) for name in names]

    # a session is in several slices only if its visitor was cut
    grouped = parts.groupBy("session_id").agg(
        F.min("anonymous_id").alias("anonymous_id"),
        F.min("session_started_at").alias("started_at"),
        F.max("occurred_at").alias("ended_at"),
        *sums("events", "page_views", "searches"),
        *[(F.sum(name) > 0).alias(name) for name in FLAGS],
        F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd"),
        F.max("_user").alias("_user"),
        F.max("_first").alias("_first"),
        F.min("_referrer").alias("_referrer"),
        F.min("_entry").alias("_entry"),
        F.max("_exit").alias("_exit"),
        *[F.min(name).alias(name) for name in _step_names(steps)],
    )
    grouped = grouped.join(_distinct_values(sessionized), "session_id", "left")

    def counted(name: str) -> Column:
        return F.coalesce(F.col(f"_{name}"), F.lit(0)).alias(name)

    columns = [
        "session_id",
        "anonymous_id",
        uuid_key("anonymous_id").alias("visitor_key"),
        F.col("_user.value").alias("user_id"),
        "started_at",
        "ended_at",
        F.to_date("started_at").alias("session_date"),
        seconds_between(F.col("ended_at"), F.col("started_at")).alias("duration_seconds"),
        "events",
        "page_views",
        counted("unique_pages"),
        "searches",
        is_bounce(
            F.col("page_views"),
            F.col("viewed_product"),
            F.col("added_to_cart"),
            F.col("started_checkout"),
            F.col("purchased"),
        ).alias("is_bounce"),
        "viewed_product",
        "added_to_cart",
        "started_checkout",
        "purchased",
        counted("products_viewed"),
        counted("orders"),
        "revenue_usd",
        *[F.col(f"_first.value.{name}") for name in FIRST_EVENT],
        F.col("_referrer.value").alias("landing_referrer"),
        F.col("_entry.value").alias("entry_page_path"),
        F.col("_exit.value").alias("exit_page_path"),
        channel(F.col("_first.value.utm_medium"), F.col("_first.value.utm_source")).alias("channel"),
    ]
    if steps:
        columns.append(F.array(*_step_names(steps)).alias("step_times"))
    return grouped.select(*columns)


#: Whether an event happened in a session.
FLAGS = {
    "viewed_product": "product_view",
    "added_to_cart": "add_to_cart",
    "started_checkout": "checkout_start",
    "purchased": "purchase",
}


def _step_names(steps: list[str]) -> list[str]:
    return [f"_step_{i}" for i in range(1, len(steps) + 1)]


def _session_parts(sessionized: DataFrame, steps: list[str]) -> DataFrame:
    """One row per session and slice of its visitor, the session's last event in the slice.

    Counts are differences of running ones between two such rows. A running pick holds the session
    that it was made in; one of an earlier session does not count.
    """
    in_order = Window.partitionBy("anonymous_id", SLICE).orderBy("occurred_at", "event_id")
    so_far = in_order.rowsBetween(*SO_FAR)
    started, seq = F.col("session_started_at"), F.col("event_seq_in_session")

    def happened(name: str) -> Column:
        return F.col("event_name") == name

    def pick(value: Column, test: Column, first: bool) -> Column:
        """The value of the session's first or last event that the test holds for, after `place`."""
        place = -seq if first else seq
        held = F.when(test, F.struct(started.alias("of"), place.alias("place"), value.alias("value")))
        return F.max(held).over(so_far)

    counted = {"events": F.lit(1), "page_views": happened("page_view"), "searches": happened("search")}
    counted |= {name: happened(event) for name, event in FLAGS.items()}
    running = {name: F.sum(test.cast("bigint")).over(so_far) for name, test in counted.items()}
    revenue = F.coalesce("order_revenue_usd", F.lit(0)).cast("decimal(18,2)")
    running["revenue_usd"] = F.sum(revenue).over(so_far)
    user, referrer, path = F.col("user_id"), F.col("referrer"), F.col("page_path")
    picks = {
        "_user": pick(user, user.isNotNull(), first=False),
        "_first": pick(F.struct(*FIRST_EVENT), seq == 1, first=True),
        "_referrer": pick(referrer, referrer.isNotNull(), first=True),
        "_entry": pick(path, happened("page_view"), first=True),
        "_exit": pick(path, happened("page_view"), first=False),
    }
    for name, step in zip(_step_names(steps), steps, strict=True):
        picks[name] = pick(F.col("occurred_at"), happened(step), first=True)
    last = sessionized.select(
        "anonymous_id", SLICE, "session_id", "session_started_at", "occurred_at", "event_id",
        F.struct(*[column.alias(name) for name, column in running.items()]).alias("_running"),
        *[column.alias(name) for name, column in picks.items()],
        F.lead(started).over(in_order).eqNullSafe(started).alias("_goes_on"),
    ).where(~F.col("_goes_on"))
    parts = last.withColumn("_before", F.lag("_running").over(in_order))

    def made_here(name: str) -> Column:
        held = F.when(F.col(name)["of"] == started, F.col(name))
        if name.startswith("_step"):
            return held["value"].alias(name)
        place = F.abs(held["place"]).alias("place")
        return F.when(held.isNotNull(), F.struct(place, held["value"].alias("value"))).alias(name)

    return parts.select(
        "session_id",
        "anonymous_id",
        "session_started_at",
        "occurred_at",
        *[
            (F.col(f"_running.{name}") - F.coalesce(F.col(f"_before.{name}"), F.lit(0))).alias(name)
            for name in running
        ],
        *[made_here(name) for name in picks],
    )


def _distinct_values(sessionized: DataFrame) -> DataFrame:
    """Distinct pages, products and orders per session."""

    def item(kind: str, column: str, test: Column | None = None) -> Column:
        keep = F.col(column).isNotNull() if test is None else F.col(column).isNotNull() & test
        return F.when(keep, F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value")))

    items = F.array_compact(
        F.array(
            item("page", "page_path", F.col("event_name") == "page_view"),
            item("product", "product_id", F.col("event_name") == "product_view"),
            item("order", "order_id"),
        )
    )
    return (
        sessionized.select("session_id", F.inline(items))
        .distinct()
        .groupBy("session_id")
        .agg(
            F.count_if(F.col("kind") == "page").alias("_unique_pages"),
            F.count_if(F.col("kind") == "product").alias("_products_viewed"),
            F.count_if(F.col("kind") == "order").alias("_orders"),
        )
    )
