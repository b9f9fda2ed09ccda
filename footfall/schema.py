"""Fixed names, value lists and table schemas."""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values -----------------------------------------------------------
FUNNEL_STEPS = ["page_view", "product_view", "add_to_cart", "checkout_start", "purchase"]
EVENT_NAMES = FUNNEL_STEPS + ["search"]
SESSION_TIMEOUT_MINUTES = 30
INGEST_OVERLAP_MINUTES = 15
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
CHANNELS = [
    "direct",
    "organic_search",
    "paid_search",
    "paid_social",
    "organic_social",
    "email",
    "referral",
    "other",
]
ALL_CHANNELS = "(all channels)"
REJECT_VALUE_CHARS = 8000
REJECT_KEY_CHARS = 512

LOG_MESSAGE = (
    "topic STRING, partition INT, offset BIGINT, key BINARY, value BINARY, timestamp TIMESTAMP"
)

RAW_EVENTS = (
    "event_id STRING, event_name STRING, anonymous_id STRING, occurred_at TIMESTAMP, "
    "payload STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, "
    "batch_id BIGINT, ingested_at TIMESTAMP"
)

DEAD_LETTERS = (
    "dead_letter_id STRING, batch_id BIGINT, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, message_key STRING, message_value STRING, error STRING, "
    "rejected_at TIMESTAMP"
)

INGEST_BATCHES = (
    "batch_id BIGINT, consumer_group STRING, topic STRING, started_at TIMESTAMP, "
    "finished_at TIMESTAMP, status STRING, messages_read BIGINT, rows_inserted BIGINT, "
    "rows_duplicate BIGINT, rows_rejected BIGINT, offsets MAP<INT, BIGINT>, error STRING"
)

MODEL_RUNS = (
    "model_run_id STRING, run_id STRING, model_name STRING, materialized STRING, "
    "started_at TIMESTAMP, finished_at TIMESTAMP, status STRING, rows_affected BIGINT, "
    "full_refresh BOOLEAN, error STRING"
)

TEST_RESULTS = (
    "test_result_id STRING, run_id STRING, model_name STRING, column_name STRING, "
    "test_name STRING, status STRING, failing_rows BIGINT, executed_at TIMESTAMP, error STRING"
)

# Payload fields read by staging. Leaves are text so that a number, a string
# holding a number and a missing field are all told apart by the cast.
PAYLOAD = (
    "user_id STRING, "
    "page STRUCT<path: STRING, title: STRING, type: STRING, referrer: STRING>, "
    "device STRUCT<type: STRING, browser: STRING, os: STRING>, "
    "geo STRUCT<country: STRING>, "
    "utm STRUCT<source: STRING, medium: STRING, campaign: STRING>, "
    "product STRUCT<product_id: STRING, name: STRING, category: STRING, "
    "price_usd: STRING, quantity: STRING>, "
    "search STRUCT<query: STRING, results_count: STRING>, "
    "cart STRUCT<value_usd: STRING, item_count: STRING>, "
    "`order` STRUCT<order_id: STRING, revenue_usd: STRING, shipping_usd: STRING, "
    "item_count: STRING>"
)

# The built relations, in the order reports list them.
RELATIONS = [
    "stg.stg_events",
    "stg.int_sessionized_events",
    "mart.dim_visitor",
    "mart.dim_page",
    "mart.dim_product",
    "mart.fct_sessions",
    "mart.fct_page_views",
    "mart.fct_funnel_steps",
    "mart.agg_daily_traffic",
    "mart.agg_funnel_conversion",
]
# --- end of fixed values ----------------------------------------------------


def names(ddl: str) -> list[str]:
    """Column names of a schema above."""
    return StructType.fromDDL(ddl).names
