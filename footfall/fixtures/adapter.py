"""Maps the test table `events` onto web events, in SQL that two engines share.

The expressions below run unchanged in Spark and in the engine that checks the
results; only JSON access, the text type and time formatting differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import configure

SPARK = {
    "S": "STRING",
    "J": "get_json_object(props,'$.k')",
    "ISO": "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "BASIC": "date_format({}, \"yyyyMMdd'T'HHmmss.SSSSSS\")",
}
DUCK = {
    "S": "VARCHAR",
    "J": "json_extract_string(props,'$.k')",
    "ISO": "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')",
    "BASIC": "strftime({}, '%Y%m%dT%H%M%S.%f')",
}

# name, expression over events plus h (hash of the id), k and d (day of month)
COLUMNS = [
    ("event_id", "substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)"
                 "||'-'||substr(h,21,12)"),
    ("event_name", "CASE WHEN k<50 THEN 'page_view' WHEN k<68 THEN 'product_view' "
                   "WHEN k<74 THEN 'search' WHEN k<84 THEN 'add_to_cart' "
                   "WHEN k<92 THEN 'checkout_start' ELSE 'purchase' END"),
    ("anonymous_id", "'anon_'||lpad(CAST(user_id AS {S}),6,'0')"),
    ("user_id", "CASE WHEN user_id % 4 = 0 AND event_id % 3 = 0 "
                "THEN 'u_'||CAST(user_id + event_id % 2 AS {S}) END"),
    ("occurred_at", "ts"),
    ("page_path", "CASE WHEN event_id % 29 <> 0 THEN '/p/'||CAST(event_id % 17 AS {S}) END"),
    ("page_title", "'T'||CAST(event_id % 17 AS {S})||CASE WHEN event_id % 10 < 4 THEN ' new' ELSE '' END"),
    ("page_type", "CASE event_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'category' ELSE 'product' END"),
    ("referrer", "CASE WHEN event_id % 5 = 0 THEN 'https://r'||CAST(event_id % 7 AS {S})||'.example/' END"),
    ("device_type", "CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END"),
    ("browser", "CASE event_id % 4 WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox' WHEN 2 THEN 'safari' END"),
    ("os", "CASE event_id % 3 WHEN 0 THEN 'linux' WHEN 1 THEN 'android' ELSE 'ios' END"),
    ("country", "CASE (user_id + event_id) % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'US' "
                "WHEN 3 THEN 'JP' END"),
    ("utm_source", "CASE WHEN (user_id + d) % 10 > 1 THEN 's'||CAST((user_id + d) % 10 AS {S}) END"),
    ("utm_medium", "CASE (user_id + d) % 10 WHEN 2 THEN 'organic' WHEN 3 THEN 'cpc' "
                   "WHEN 4 THEN 'email' WHEN 5 THEN 'paid_social' WHEN 6 THEN 'social' "
                   "WHEN 7 THEN 'referral' WHEN 8 THEN 'affiliate' END"),
    ("utm_campaign", "CASE WHEN (user_id + d) % 10 > 3 THEN 'c'||CAST(event_id % 6 AS {S}) END"),
    ("product_id", "CASE WHEN has_product THEN 'prod_'||CAST(k % 8 AS {S}) END"),
    ("product_name", "CASE WHEN has_product THEN 'Product '||CAST(k % 8 AS {S})"
                     "||CASE WHEN event_id % 10 = 0 THEN ' (old)' ELSE '' END END"),
    ("product_category", "CASE WHEN has_product AND event_id % 11 <> 0 "
                         "THEN 'cat_'||CAST((k + event_id % 2) % 4 AS {S}) END"),
    ("product_price_usd", "CASE WHEN has_product AND event_id % 13 <> 0 "
                          "THEN CAST(value + 1 AS DECIMAL(12,2)) END"),
    ("quantity", "CASE WHEN has_product THEN CAST(1 + event_id % 3 AS INT) END"),
    ("search_query", "CASE WHEN k >= 68 AND k < 74 THEN 'query '||CAST(k AS {S}) END"),
    ("search_results_count", "CASE WHEN k >= 68 AND k < 74 THEN CAST(event_id % 50 AS INT) END"),
    ("cart_value_usd", "CASE WHEN k >= 84 AND k < 92 THEN CAST(value * 2 + 1 AS DECIMAL(12,2)) END"),
    ("cart_item_count", "CASE WHEN k >= 84 AND k < 92 THEN CAST(1 + k % 4 AS INT) END"),
    ("order_id", "CASE WHEN k >= 92 THEN 'ord_'||substr(h,1,12) END"),
    ("order_revenue_usd", "CASE WHEN k >= 92 THEN CAST(value + 1 AS DECIMAL(12,2)) END"),
    ("order_shipping_usd", "CASE WHEN k >= 92 THEN CAST(k % 10 AS DECIMAL(12,2)) END"),
    ("order_item_count", "CASE WHEN k >= 92 THEN CAST(1 + k % 3 AS INT) END"),
    ("ingested_at", "ts + (event_id % 20) * INTERVAL '1' MINUTE"),
]

# read only by the adapter's later stages
KEPT = [
    ("h", "h"), ("k", "k"), ("ts", "ts"), ("event_type", "event_type"),
    ("kafka_partition", "CAST(user_id % 6 AS INT)"),
    ("kafka_offset", "CAST(event_id AS BIGINT)"),
    ("batch_id", "CAST(d AS BIGINT)"),
]


def _quoted(name: str, column: str) -> str:
    return f"'\"{name}\":'||coalesce('\"'||{column}||'\"','null')"


def _number(name: str, column: str) -> str:
    return f"'\"{name}\":'||coalesce(CAST({column} AS {{S}}),'null')"


def _object(name: str, *fields: str) -> str:
    return f"'\"{name}\":{{{{'||" + "||','||".join(fields) + "||'}}'"


# JSON document of an event, over COLUMNS
PAYLOAD = "'{{'||" + "||','||".join([
    _quoted("event_id", "event_id"),
    _quoted("event_name", "event_name"),
    _quoted("anonymous_id", "anonymous_id"),
    _quoted("user_id", "user_id"),
    "'\"occurred_at\":\"'||{AT}||'\"'",
    _object("page", _quoted("path", "page_path"), _quoted("title", "page_title"),
            _quoted("type", "page_type"), _quoted("referrer", "referrer")),
    _object("device", _quoted("type", "device_type"), _quoted("browser", "browser"), _quoted("os", "os")),
    _object("geo", _quoted("country", "country")),
    _object("utm", _quoted("source", "utm_source"), _quoted("medium", "utm_medium"),
            _quoted("campaign", "utm_campaign")),
]) + "".join([
    "||CASE WHEN product_id IS NULL THEN '' ELSE ','||"
    + _object("product", _quoted("product_id", "product_id"), _quoted("name", "product_name"),
              _quoted("category", "product_category"), _number("price_usd", "product_price_usd"),
              _number("quantity", "quantity")) + " END",
    "||CASE WHEN search_query IS NULL THEN '' ELSE ','||"
    + _object("search", _quoted("query", "search_query"),
              _number("results_count", "search_results_count")) + " END",
    "||CASE WHEN cart_value_usd IS NULL THEN '' ELSE ','||"
    + _object("cart", _number("value_usd", "cart_value_usd"),
              _number("item_count", "cart_item_count")) + " END",
    "||CASE WHEN order_id IS NULL THEN '' ELSE ','||"
    + _object("order", _quoted("order_id", "order_id"), _number("revenue_usd", "order_revenue_usd"),
              _number("shipping_usd", "order_shipping_usd"),
              _number("item_count", "order_item_count")) + " END",
]) + "||'}}'"

# Every event of type 'error' is sent damaged, or in an unusual but valid form,
# chosen by k; all other events are sent as they are.
DAMAGED = f"""CASE WHEN event_type <> 'error' THEN payload
 WHEN k < 3 THEN NULL
 WHEN k < 6 THEN '{{{{not json'
 WHEN k < 9 THEN '[1,2,3]'
 WHEN k < 12 THEN replace(payload, anonymous_id, '   ')
 WHEN k < 14 THEN replace(payload, 'event_id', 'other_id')
 WHEN k < 17 THEN replace(payload, '"page_view"', '"rage_click"')
 WHEN k < 20 THEN replace(payload, event_id, 'evt-1')
 WHEN k < 23 THEN replace(payload, {{AT}}, 'last tuesday')
 WHEN k < 26 THEN replace(payload, {{AT}}, {{AT}}||'Z')
 WHEN k < 29 THEN replace(payload, {{AT}}, {{ISO_PLUS_2}}||'+02:00')
 WHEN k < 32 THEN replace(payload, event_id, '{{{{'||upper(h)||'}}}}')
 WHEN k < 35 THEN replace(payload, {{AT}}, {{BASIC_AT}})
 WHEN k < 37 THEN payload||'}}}}'
 WHEN k < 38 THEN payload||'],['
 WHEN k < 40 THEN '  '||payload||' '
 WHEN k >= 50 AND k < 54 THEN replace(payload, '"product_id":"'||product_id, '"product_id":"')
 WHEN k >= 92 AND k < 94 THEN replace(payload, order_id, '')
 WHEN k >= 94 AND k < 96 THEN replace(payload, '"revenue_usd":', '"revenue_usd":-')
 WHEN k = 96 THEN replace(payload, '"revenue_usd":', '"revenue_usd":"12","old":')
 ELSE payload END"""
BAD_BYTES = "event_type = 'error' AND k >= 54 AND k < 57"

TOPIC = "web.events"


def _fill(text: str, engine: dict[str, str]) -> str:
    return text.format(
        S=engine["S"],
        AT=engine["ISO"].format("occurred_at"),
        ISO_PLUS_2=engine["ISO"].format("occurred_at + INTERVAL '2' HOUR"),
        BASIC_AT=engine["BASIC"].format("occurred_at"),
    )


def base_sql(engine: dict[str, str]) -> str:
    flag = "(k >= 50 AND k < 68) OR (k >= 74 AND k < 84)"
    return (
        f"SELECT *, {flag} AS has_product FROM (SELECT *, md5(CAST(event_id AS {engine['S']})) AS h, "
        f"CAST({engine['J']} AS INT) AS k, extract(day FROM ts) AS d FROM events)"
    )


def columns_sql(engine: dict[str, str], kept: bool = False) -> str:
    chosen = COLUMNS + (KEPT if kept else [])
    return ", ".join(f"{_fill(expr, engine)} AS {name}" for name, expr in chosen)


def staged_sql(engine: dict[str, str], kept: bool = False) -> str:
    return f"SELECT {columns_sql(engine, kept)} FROM ({base_sql(engine)})"


def messages_sql(engine: dict[str, str]) -> str:
    """Log messages with their value as text; bad_bytes marks those sent as bad UTF-8."""
    return (
        f"SELECT *, {_fill(DAMAGED, engine)} AS sent, {BAD_BYTES} AS bad_bytes FROM "
        f"(SELECT *, {_fill(PAYLOAD, engine)} AS payload FROM ({staged_sql(engine, kept=True)}))"
    )


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    configure(spark)
    return spark.sql(sql.replace("FROM events", f"FROM parquet.`{sf_dir}/events.parquet`"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging relation: 30 typed columns, one row per event."""
    df = _run(spark, sf_dir, staged_sql(SPARK))
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("occurred_at", "ingested_at")})


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed events: promoted columns and the JSON payload."""
    sql = (
        f"SELECT event_id, event_name, anonymous_id, occurred_at, {_fill(PAYLOAD, SPARK)} AS payload, "
        f"'{TOPIC}' AS kafka_topic, kafka_partition, kafka_offset, batch_id, ingested_at "
        f"FROM ({staged_sql(SPARK, kept=True)})"
    )
    df = _run(spark, sf_dir, sql)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("occurred_at", "ingested_at")})


def messages(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> DataFrame:
    """Log messages, some damaged; with `redelivered`, all views come a second time."""
    df = _run(spark, sf_dir, messages_sql(SPARK))
    value = F.when(F.col("bad_bytes"), F.unhex(F.lit("FFFE00"))).otherwise(F.col("sent").cast("binary"))

    def envelope(rows: DataFrame, later: int) -> DataFrame:
        return rows.select(
            F.lit(TOPIC).alias("kafka_topic"),
            "kafka_partition",
            (F.col("kafka_offset") + later).alias("kafka_offset"),
            F.col("anonymous_id").cast("binary").alias("message_key"),
            value.alias("message_value"),
            "batch_id",
        )

    sent = envelope(df, 0)
    if redelivered:
        sent = sent.unionByName(envelope(df.where(F.col("event_type") == "view"), REDELIVERY_OFFSET))
    return sent


REDELIVERY_OFFSET = 1_000_000_000
