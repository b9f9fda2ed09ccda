"""Typed event rows from landed JSON, and the incremental slice to re-read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schema

INGEST_DATE = "ingest_date"


def _text(path: str) -> Column:
    """A payload field as text, empty text as null."""
    return F.nullif(F.col(path), F.lit(""))


def flatten_events(raw: DataFrame) -> DataFrame:
    """One typed row per landed event: 30 columns, the JSON parsed once.

    A number that cannot be cast raises (ANSI mode), as a bad cast does in SQL.
    """
    doc = raw.withColumn("doc", F.from_json("payload", schema.PAYLOAD))
    return doc.select(
        "event_id",
        "event_name",
        "anonymous_id",
        _text("doc.user_id").alias("user_id"),
        "occurred_at",
        _text("doc.page.path").alias("page_path"),
        _text("doc.page.title").alias("page_title"),
        _text("doc.page.type").alias("page_type"),
        _text("doc.page.referrer").alias("referrer"),
        _text("doc.device.type").alias("device_type"),
        _text("doc.device.browser").alias("browser"),
        _text("doc.device.os").alias("os"),
        _text("doc.geo.country").alias("country"),
        _text("doc.utm.source").alias("utm_source"),
        _text("doc.utm.medium").alias("utm_medium"),
        _text("doc.utm.campaign").alias("utm_campaign"),
        _text("doc.product.product_id").alias("product_id"),
        _text("doc.product.name").alias("product_name"),
        _text("doc.product.category").alias("product_category"),
        F.col("doc.product.price_usd").cast("decimal(12,2)").alias("product_price_usd"),
        F.col("doc.product.quantity").cast("int").alias("quantity"),
        _text("doc.search.query").alias("search_query"),
        F.col("doc.search.results_count").cast("int").alias("search_results_count"),
        F.col("doc.cart.value_usd").cast("decimal(12,2)").alias("cart_value_usd"),
        F.col("doc.cart.item_count").cast("int").alias("cart_item_count"),
        _text("doc.order.order_id").alias("order_id"),
        F.col("doc.order.revenue_usd").cast("decimal(12,2)").alias("order_revenue_usd"),
        F.col("doc.order.shipping_usd").cast("decimal(12,2)").alias("order_shipping_usd"),
        F.col("doc.order.item_count").cast("int").alias("order_item_count"),
        "ingested_at",
    )


def incremental_slice(
    raw: DataFrame,
    target: DataFrame | None,
    overlap_minutes: int = schema.INGEST_OVERLAP_MINUTES,
) -> DataFrame:
    """Raw rows landed since `overlap_minutes` before the newest row of `target`.

    Writers commit out of order, so the newest minutes are read again; the keyed
    upsert that follows makes the repeat harmless. The one-row watermark is read
    first and pushed into the scan as a constant, so Parquet skips old row groups,
    and old partitions too where `raw` is partitioned by ingest_date. With no target,
    or an empty one, everything is read.
    """
    newest = target.select(F.max("ingested_at").alias("t")).first()["t"] if target is not None else None
    if newest is None:
        return raw
    floor = F.lit(newest) - F.make_dt_interval(mins=F.lit(overlap_minutes))
    recent = F.col("ingested_at") >= floor
    if INGEST_DATE in raw.columns:
        recent = recent & (F.col(INGEST_DATE) >= F.to_date(floor))
    return raw.where(recent)


def event_name_counts(events: DataFrame) -> DataFrame:
    """Events per name, most frequent first."""
    return (
        events.groupBy("event_name")
        .agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), "event_name")
    )
