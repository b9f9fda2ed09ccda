"""Visitor, page and product dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.keys import uuid_key


def _named(event: str) -> Column:
    return F.col("event_name") == event


FIRST_TOUCH = {
    "first_device_type": "device_type",
    "first_browser": "browser",
    "first_os": "os",
    "first_country": "country",
    "first_utm_source": "utm_source",
    "first_utm_medium": "utm_medium",
    "first_utm_campaign": "utm_campaign",
}


def dim_visitor(stg: DataFrame) -> DataFrame:
    """One row per tracking cookie: activity, revenue, first-touch attributes."""
    order = F.struct("occurred_at", "event_id")
    signed_in = F.col("user_id").isNotNull()
    grouped = stg.groupBy("anonymous_id").agg(
        F.max_by("user_id", F.when(signed_in, order)).alias("user_id"),
        F.bool_or(signed_in).alias("is_identified"),
        F.min("occurred_at").alias("first_seen_at"),
        F.max("occurred_at").alias("last_seen_at"),
        F.count("*").alias("lifetime_events"),
        F.count_if(_named("page_view")).alias("lifetime_page_views"),
        F.count_distinct("order_id").alias("lifetime_orders"),
        F.coalesce(F.sum("order_revenue_usd"), F.lit(0))
        .cast("decimal(28,2)")
        .alias("lifetime_revenue_usd"),
        F.min_by(F.struct(*FIRST_TOUCH.values()), order).alias("first"),
    )
    return grouped.select(
        uuid_key("anonymous_id").alias("visitor_key"),
        "anonymous_id",
        "user_id",
        "is_identified",
        "first_seen_at",
        "last_seen_at",
        "lifetime_events",
        "lifetime_page_views",
        "lifetime_orders",
        "lifetime_revenue_usd",
        *[F.col(f"first.{source}").alias(name) for name, source in FIRST_TOUCH.items()],
    )


def dim_visitor_from_sessions(sessions: DataFrame, stg: DataFrame) -> DataFrame:
    """`dim_visitor` where sessions are built already: events are read for their orders alone.

    A visitor's first touch is that of the first session, the last user that of the last session
    with one; a session's start is its visitor's alone, so there are no ties.
    """
    first = F.struct(*[F.col(source).alias(name) for name, source in FIRST_TOUCH.items()])
    signed_in = F.when(F.col("user_id").isNotNull(), F.col("started_at"))
    visitors = sessions.groupBy("anonymous_id").agg(
        F.max_by("user_id", signed_in).alias("user_id"),
        F.min("started_at").alias("first_seen_at"),
        F.max("ended_at").alias("last_seen_at"),
        F.sum("events").alias("lifetime_events"),
        F.sum("page_views").alias("lifetime_page_views"),
        F.sum("revenue_usd").cast("decimal(28,2)").alias("lifetime_revenue_usd"),
        F.min_by(first, "started_at").alias("first"),
    )
    orders = (
        stg.where(F.col("order_id").isNotNull())
        .select("anonymous_id", "order_id")
        .distinct()
        .groupBy("anonymous_id")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return visitors.join(orders, "anonymous_id", "left").select(
        uuid_key("anonymous_id").alias("visitor_key"),
        "anonymous_id",
        "user_id",
        F.col("user_id").isNotNull().alias("is_identified"),
        "first_seen_at",
        "last_seen_at",
        "lifetime_events",
        "lifetime_page_views",
        F.coalesce("orders", F.lit(0)).alias("lifetime_orders"),
        "lifetime_revenue_usd",
        *[F.col(f"first.{name}").alias(name) for name in FIRST_TOUCH],
    )


def _per_value(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key, kind (a name of `columns`) and value."""
    pairs = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns]
    return df.withColumns({"_pair": F.explode(F.array(*pairs))}).withColumns(
        {"kind": F.col("_pair.kind"), "value": F.col("_pair.value")}
    )


def _mode(kind: str) -> Column:
    """Most frequent non-null value of a kind, the lowest of equals."""
    rank = F.struct(-F.col("n"), F.col("value"))
    counted = (F.col("kind") == kind) & F.col("value").isNotNull()
    return F.min_by("value", F.when(counted, rank))


def dim_page(stg: DataFrame) -> DataFrame:
    """One row per visited path, labelled by its most frequent title and type.

    Titles, types and visitors are first counted per (page, value) and then per
    page, so a page with a third of all views is spread over many tasks.
    """
    views = stg.where(_named("page_view") & F.col("page_path").isNotNull())
    counts = (
        _per_value(views, "page_path", ["page_title", "page_type", "anonymous_id"])
        .groupBy("page_path", "kind", "value")
        .agg(
            F.count("*").alias("n"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
        )
    )
    visitor = F.col("kind") == "anonymous_id"
    # all visitors of a page into one row, before the labels are compared
    labels = counts.groupBy("page_path", "kind", F.when(~visitor, F.col("value")).alias("value")).agg(
        F.sum("n").alias("n"),
        F.count("value").alias("values"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
    return (
        labels.groupBy("page_path")
        .agg(
            _mode("page_title").alias("page_title"),
            _mode("page_type").alias("page_type"),
            F.sum(F.when(visitor, F.col("n"))).alias("lifetime_page_views"),
            F.sum(F.when(visitor, F.col("values"))).alias("lifetime_visitors"),
            F.min("first_at").alias("first_seen_at"),
            F.max("last_at").alias("last_seen_at"),
        )
        .select(
            uuid_key("page_path").alias("page_key"),
            "page_path",
            "page_title",
            "page_type",
            "lifetime_page_views",
            "lifetime_visitors",
            "first_seen_at",
            "last_seen_at",
        )
    )


def dim_product(stg: DataFrame) -> DataFrame:
    """One row per product seen: labels, price range, views and carts.

    Events are reduced to numbers by name and category first. The latest price is then looked up
    at its time, so that of all events only those of that moment are compared by id.
    """
    cart, priced = _named("add_to_cart"), F.col("product_price_usd").isNotNull()
    seen = stg.where(F.col("product_id").isNotNull())
    parts = (
        seen.groupBy("product_id", "product_name", "product_category")
        .agg(
            F.count("*").alias("n"),
            F.max(F.when(priced, F.col("occurred_at"))).alias("priced_at"),
            F.min("product_price_usd").alias("low"),
            F.max("product_price_usd").alias("high"),
            F.count_if(_named("product_view")).alias("views"),
            F.count_if(cart).alias("carts"),
            F.sum(F.when(cart, F.col("quantity"))).alias("units"),
            F.min("occurred_at").alias("first_at"),
            F.max("occurred_at").alias("last_at"),
        )
    )
    # Each part appears once per kind, so sums are taken over one kind only.
    once = F.col("kind") == "product_name"
    values = (
        _per_value(parts, "product_id", ["product_name", "product_category"])
        .groupBy("product_id", "kind", "value")
        .agg(
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("views").alias("views"),
            F.sum("carts").alias("carts"),
            F.sum("units").alias("units"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )
    latest = parts.groupBy("product_id").agg(F.max("priced_at").alias("occurred_at"))
    prices = (
        seen.where(priced)
        .join(latest, ["product_id", "occurred_at"])
        .groupBy("product_id")
        .agg(F.max_by("product_price_usd", "event_id").alias("latest_price_usd"))
    )
    return (
        values.groupBy("product_id")
        .agg(
            _mode("product_name").alias("product_name"),
            _mode("product_category").alias("category"),
            F.min("low").alias("min_price_usd"),
            F.max("high").alias("max_price_usd"),
            F.sum(F.when(once, F.col("views"))).alias("lifetime_product_views"),
            F.sum(F.when(once, F.col("carts"))).alias("lifetime_add_to_carts"),
            F.coalesce(F.sum(F.when(once, F.col("units"))), F.lit(0)).alias("lifetime_units_added"),
            F.min("first_at").alias("first_seen_at"),
            F.max("last_at").alias("last_seen_at"),
        )
        .join(prices, "product_id", "left")
        .select(
            uuid_key("product_id").alias("product_key"),
            "product_id",
            "product_name",
            "category",
            "latest_price_usd",
            "min_price_usd",
            "max_price_usd",
            "lifetime_product_views",
            "lifetime_add_to_carts",
            "lifetime_units_added",
            "first_seen_at",
            "last_seen_at",
        )
    )
