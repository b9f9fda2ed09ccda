"""Daily traffic by channel and device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.rounding import from_units, half_up_div, percent, ratio, to_units


def daily_traffic(sessions: DataFrame) -> DataFrame:
    """One row per (session_date, channel, device_type) of `fct_sessions`.

    Order value divides revenue by orders; revenue per session divides by sessions.
    """
    grouped = sessions.groupBy("session_date", "channel", "device_type").agg(
        F.count("*").alias("sessions"),
        F.count_distinct("anonymous_id").alias("visitors"),
        F.sum("events").alias("events"),
        F.sum("page_views").alias("page_views"),
        F.sum("searches").alias("searches"),
        F.count_if("is_bounce").alias("bounced_sessions"),
        F.count_if("viewed_product").alias("sessions_viewed_product"),
        F.count_if("added_to_cart").alias("sessions_added_to_cart"),
        F.count_if("started_checkout").alias("sessions_started_checkout"),
        F.count_if("purchased").alias("sessions_purchased"),
        F.sum("orders").alias("orders"),
        F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd"),
        F.sum("duration_seconds").alias("_seconds"),
    )
    sessions_n, cents = F.col("sessions"), to_units(F.col("revenue_usd"), 2)
    return grouped.withColumns(
        {
            "bounce_rate_pct": percent(F.col("bounced_sessions"), sessions_n),
            "conversion_rate_pct": percent(F.col("sessions_purchased"), sessions_n),
            "avg_session_seconds": ratio(F.col("_seconds"), sessions_n, 1),
            "avg_page_views": ratio(F.col("page_views"), sessions_n, 2),
            "revenue_per_session_usd": from_units(half_up_div(cents, sessions_n, wide=True), 2),
            "avg_order_value_usd": from_units(half_up_div(cents, F.col("orders"), wide=True), 2),
        }
    ).drop("_seconds")
