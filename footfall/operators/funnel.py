"""Sequential funnel: steps reached per session, and conversion by channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall import schema
from footfall.functions.rounding import percent, ratio, seconds_between
from footfall.operators.sessions import step_time_columns


def step_list(steps: str) -> Column:
    """Comma-separated step names as rows of (step_index from 1, step_name)."""
    names = F.split(F.lit(steps), ",")
    return F.inline(
        F.transform(
            names,
            lambda name, i: F.struct((i + 1).alias("step_index"), name.alias("step_name")),
        )
    )


def filter_steps(events: DataFrame, steps: list[str]) -> DataFrame:
    """Events whose name is a funnel step."""
    return events.where(F.col("event_name").isin(steps))


def first_hit(sessionized: DataFrame, steps: list[str] = schema.FUNNEL_STEPS) -> DataFrame:
    """Earliest time of each step in each session; repeats add nothing."""
    return (
        filter_steps(sessionized, steps)
        .groupBy("session_id", "event_name")
        .agg(F.min("occurred_at").alias("reached_at"))
    )


def with_step_times(
    sessions: DataFrame, sessionized: DataFrame, steps: list[str] = schema.FUNNEL_STEPS
) -> DataFrame:
    """Stored sessions with their `step_times`, for sessions built without them."""
    columns = step_time_columns(steps)
    times = (
        filter_steps(sessionized, steps)
        .groupBy("session_id")
        .agg(*[column.alias(name) for name, column in columns.items()])
        .select("session_id", F.array(*columns).alias("step_times"))
    )
    return sessions.join(times, "session_id")


def funnel_steps(sessions: DataFrame, steps: list[str] = schema.FUNNEL_STEPS) -> DataFrame:
    """One row per session and step it reached in order.

    `sessions` is `fct_sessions(..., steps=steps)` or `with_step_times(...)`. Step N
    counts only if steps 1..N-1 were reached too, none later than the next. With the
    first times side by side in one row this is a comparison of neighbours: no join,
    no shuffle.
    """
    if len(set(steps)) != len(steps):
        raise ValueError("funnel steps must be distinct")
    at = [F.col("step_times")[i] for i in range(len(steps))]
    reached = at[0].isNotNull()
    depth = reached.cast("int")
    for previous, current in zip(at, at[1:]):
        # a missing time makes the comparison null, which ends the sequence
        reached = reached & F.coalesce(current >= previous, F.lit(False))
        depth = depth + reached.cast("int")

    index = F.explode(F.when(F.col("_depth") > 0, F.sequence(F.lit(1), F.col("_depth"))))
    rows = sessions.withColumn("_depth", depth).select("*", index.alias("step_index"))
    reached_at = F.element_at("step_times", F.col("step_index"))
    return rows.select(
        "session_id",
        "step_index",
        F.element_at(F.array(*[F.lit(s) for s in steps]), F.col("step_index")).alias("step_name"),
        reached_at.alias("reached_at"),
        F.col("started_at").alias("session_started_at"),
        "session_date",
        "channel",
        "device_type",
        "country",
        "anonymous_id",
        F.col("revenue_usd").alias("session_revenue_usd"),
        seconds_between(reached_at, F.col("started_at")).alias("seconds_from_session_start"),
        (F.col("step_index") == F.col("_depth")).alias("is_final_step"),
    )


def funnel_reach(funnel: DataFrame) -> DataFrame:
    """Sessions and visitors per (channel, step), and per step over all channels.

    Each funnel row is its own session, as (session_id, step_index) is unique. Rows
    are first combined per visitor, which leaves the grouping sets little to expand.
    """
    channel, step = F.col("channel"), [F.col("step_index"), F.col("step_name")]
    visitors = funnel.groupBy("channel", "step_index", "step_name", "anonymous_id").agg(
        F.count("*").alias("sessions"),
        F.count_if("is_final_step").alias("stopped"),
        F.sum("seconds_from_session_start").alias("seconds"),
        F.sum(F.when(F.col("step_name") == "purchase", F.col("session_revenue_usd"))).alias("usd"),
    )
    return (
        visitors.groupingSets(
            [[channel, *step], step],
            channel,
            *step,
        )
        .agg(
            F.grouping("channel").alias("total"),
            F.sum("sessions").alias("sessions_reached"),
            F.count_distinct("anonymous_id").alias("visitors_reached"),
            F.sum("stopped").alias("sessions_stopped_here"),
            F.sum("seconds").alias("seconds"),
            F.coalesce(F.sum("usd"), F.lit(0)).cast("decimal(28,2)").alias("revenue_usd"),
        )
        .select(
            F.when(F.col("total") == 1, schema.ALL_CHANNELS)
            .otherwise(F.col("channel"))
            .alias("channel"),
            "step_index",
            "step_name",
            "sessions_reached",
            "visitors_reached",
            "sessions_stopped_here",
            ratio(F.col("seconds"), F.col("sessions_reached"), 1).alias("avg_seconds_to_reach"),
            "revenue_usd",
        )
    )


def funnel_conversion(funnel: DataFrame) -> DataFrame:
    """Per channel and step: conversion from the previous step and from entry.

    The windows run over `funnel_reach`, one row per channel and step.
    """
    by_step = Window.partitionBy("channel").orderBy("step_index")
    reach = funnel_reach(funnel).withColumns(
        {
            "sessions_entered": F.first("sessions_reached").over(by_step),
            "prev_step_sessions": F.lag("sessions_reached").over(by_step),
        }
    )
    reached, previous = F.col("sessions_reached"), F.col("prev_step_sessions")
    lost = F.coalesce(previous - reached, F.lit(0))
    return reach.select(
        "channel",
        "step_index",
        "step_name",
        "sessions_reached",
        "visitors_reached",
        "sessions_entered",
        "prev_step_sessions",
        lost.alias("sessions_lost"),
        "sessions_stopped_here",
        percent(reached, previous).alias("step_conversion_pct"),
        percent(reached, F.col("sessions_entered")).alias("overall_conversion_pct"),
        percent(lost, previous).alias("step_dropoff_pct"),
        "avg_seconds_to_reach",
        "revenue_usd",
    )
