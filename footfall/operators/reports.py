"""The report queries that read the marts and the run logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import schema
from footfall.functions.rounding import from_units, half_up_div, percent, ratio, to_units


def funnel(conversion: DataFrame, channel: str = schema.ALL_CHANNELS) -> DataFrame:
    return (
        conversion.where(F.col("channel") == channel)
        .select(
            "step_index",
            "step_name",
            "sessions_reached",
            "sessions_lost",
            "step_conversion_pct",
            "overall_conversion_pct",
            "avg_seconds_to_reach",
            "revenue_usd",
        )
        .orderBy("step_index")
    )


def funnel_channels(conversion: DataFrame) -> DataFrame:
    return conversion.select("channel").distinct().orderBy("channel")


def traffic(daily: DataFrame, days: int = 14) -> DataFrame:
    """Totals of the latest `days` dates, oldest first.

    Visitors are summed over channels and devices, so somebody seen in two of them
    on one day counts twice; average seconds are weighted by sessions.
    """
    sessions = F.col("sessions")
    latest = (
        daily.groupBy("session_date")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("visitors").alias("visitors"),
            F.sum("page_views").alias("page_views"),
            F.sum("bounced_sessions").alias("_bounced"),
            F.sum("sessions_purchased").alias("_purchased"),
            F.sum("orders").alias("orders"),
            F.sum("revenue_usd").alias("revenue_usd"),
            F.sum(to_units(F.col("avg_session_seconds"), 1) * sessions).alias("_tenths"),
        )
        .orderBy(F.desc("session_date"))
        .limit(days)
    )
    return latest.select(
        "session_date",
        "sessions",
        "visitors",
        "page_views",
        percent(F.col("_bounced"), sessions).alias("bounce_rate_pct"),
        percent(F.col("_purchased"), sessions).alias("conversion_rate_pct"),
        "orders",
        "revenue_usd",
        from_units(half_up_div(F.col("_tenths"), sessions), 1).alias("avg_session_seconds"),
    ).orderBy("session_date")


def channels(daily: DataFrame) -> DataFrame:
    sessions = F.col("sessions")
    grouped = daily.groupBy("channel").agg(
        F.sum("sessions").alias("sessions"),
        F.sum("visitors").alias("visitors"),
        F.sum("sessions_purchased").alias("_purchased"),
        F.sum("bounced_sessions").alias("_bounced"),
        F.sum("revenue_usd").alias("revenue_usd"),
    )
    per_session = half_up_div(to_units(F.col("revenue_usd"), 2), sessions)
    return grouped.select(
        "channel",
        "sessions",
        "visitors",
        percent(F.col("_purchased"), sessions).alias("conversion_rate_pct"),
        percent(F.col("_bounced"), sessions).alias("bounce_rate_pct"),
        "revenue_usd",
        from_units(per_session, 2).alias("revenue_per_session_usd"),
    ).orderBy(F.desc("sessions"), "channel")


def top_pages(page_views: DataFrame, pages: DataFrame, limit: int = 15) -> DataFrame:
    """Most viewed pages. Views are grouped per path before the dimension is joined,
    so the join is one row per page on both sides."""
    views = F.col("views")
    grouped = page_views.groupBy("page_path").agg(
        F.count("*").alias("views"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_if("is_entry_page").alias("entries"),
        F.count_if("is_exit_page").alias("exits"),
        F.sum("seconds_on_page").alias("_seconds"),
        F.count("seconds_on_page").alias("_timed"),
    )
    return (
        grouped.join(pages.select("page_path", "page_type"), "page_path")
        .select(
            "page_path",
            "page_type",
            "views",
            "sessions",
            "entries",
            "exits",
            ratio(F.col("_seconds"), F.col("_timed"), 1).alias("avg_seconds"),
            percent(F.col("exits"), views, 1).alias("exit_rate_pct"),
        )
        .orderBy(F.desc("views"), "page_path")
        .limit(limit)
    )


def top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    views, carts = F.col("lifetime_product_views"), F.col("lifetime_add_to_carts")
    return (
        products.select(
            "product_id",
            "product_name",
            "category",
            F.col("latest_price_usd").alias("price"),
            views.alias("views"),
            carts.alias("carts"),
            percent(carts, views, 1).alias("cart_rate_pct"),
        )
        .orderBy(F.desc("views"), "product_id")
        .limit(limit)
    )


def recent_batches(batches: DataFrame, limit: int = 5) -> DataFrame:
    return (
        batches.select(
            "batch_id",
            "status",
            "started_at",
            "messages_read",
            "rows_inserted",
            "rows_duplicate",
            "rows_rejected",
            "error",
        )
        .orderBy(F.desc("started_at"), F.desc("batch_id"))
        .limit(limit)
    )


def ingest_overview(raw: DataFrame, dead_letters: DataFrame) -> DataFrame:
    rejected = dead_letters.select(F.count("*")).scalar()
    return raw.agg(
        F.count("*").alias("events"),
        F.count_distinct("anonymous_id").alias("visitors"),
        F.min("occurred_at").alias("first_event_at"),
        F.max("occurred_at").alias("last_event_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    ).withColumn("dead_letters", rejected)


def count_relations(relations: dict[str, DataFrame | None]) -> DataFrame:
    """Rows of each relation, null for one that is not built."""
    spark = SparkSession.active()
    counts = []
    for place, (name, df) in enumerate(relations.items()):
        source = spark.range(1) if df is None else df
        rows = F.lit(None).cast("bigint") if df is None else F.count("*")
        counts.append(
            source.select(F.lit(place).alias("place"), F.lit(name).alias("relation"),
                          rows.alias("row_count"))
        )
    return reduce(DataFrame.unionAll, counts).orderBy("place").select("relation", "row_count")


def table_counts(spark: SparkSession, names: list[str] = schema.RELATIONS) -> DataFrame:
    """`count_relations` over catalog tables."""
    return count_relations(
        {n: spark.table(n) if spark.catalog.tableExists(n) else None for n in names}
    )


def _latest(runs: DataFrame, by: str) -> DataFrame:
    return runs.orderBy(F.desc(by), "run_id").limit(1)


def last_transform_run(model_runs: DataFrame) -> DataFrame:
    def having(status: str):
        return F.count_if(F.col("status") == status)

    runs = model_runs.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.count("*").alias("models"),
        having("success").alias("succeeded"),
        having("failed").alias("failed"),
        having("skipped").alias("skipped"),
    )
    return _latest(runs, "started_at")


def last_test_run(test_results: DataFrame) -> DataFrame:
    def having(status: str):
        return F.count_if(F.col("status") == status)

    runs = test_results.groupBy("run_id").agg(
        F.max("executed_at").alias("executed_at"),
        F.count("*").alias("tests"),
        having("pass").alias("passed"),
        having("fail").alias("failed"),
        having("error").alias("errored"),
    )
    return _latest(runs, "executed_at")


def failing_tests(test_results: DataFrame, run_id: str) -> DataFrame:
    return (
        test_results.where((F.col("run_id") == run_id) & (F.col("status") != "pass"))
        .select("model_name", "column_name", "test_name", "status", "failing_rows", "error")
        .orderBy("model_name", "test_name", "column_name")
    )
