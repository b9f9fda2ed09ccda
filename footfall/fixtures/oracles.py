"""The same results in plain SQL for another engine, from the rules in other terms.

Relations are common table expressions over the test tables; a query names those it
needs and they are put in front of it.
"""

from __future__ import annotations

from footfall import schema
from footfall.fixtures import adapter
from footfall.operators.quality import Check
from footfall.plans.checks import CHECKS

DUCK = adapter.DUCK
STEPS = ",".join(schema.FUNNEL_STEPS)


def _uuid(text: str) -> str:
    return f"CAST(CAST(md5({text}) AS UUID) AS VARCHAR)"


def _rounded(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator with `digits` decimals, halves up, as DOUBLE."""
    n, d = f"CAST({numerator} AS BIGINT)", f"nullif(CAST({denominator} AS BIGINT),0)"
    return f"CAST(((2*{10**digits}*{n}+{d})//(2*{d})) AS DOUBLE)/{10**digits}.0"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _rounded(f"100*({part})", whole, digits)


def _seconds(later: str, earlier: str) -> str:
    return f"CAST((epoch_us({later})-epoch_us({earlier})+500000)//1000000 AS BIGINT)"


def _cents(amount: str) -> str:
    return f"CAST(({amount})*100 AS BIGINT)"


def _sessionized(minutes: int) -> str:
    """An event opens a session if no event of its visitor lies in the timeout before it; all others
    belong to the last one opened before them. Numbers are places in the session's list of events."""
    opened = f"""
SELECT anonymous_id, occurred_at AS opened_at FROM stg e WHERE NOT EXISTS (
  SELECT 1 FROM stg p WHERE p.anonymous_id = e.anonymous_id
  AND p.occurred_at BETWEEN e.occurred_at - INTERVAL '{minutes}' MINUTE AND e.occurred_at
  AND (p.occurred_at < e.occurred_at OR p.event_id < e.event_id))"""
    return f"""
SELECT stg.*, opened_at AS session_started_at, place AS event_seq_in_session,
  {_uuid("stg.anonymous_id||'|'||strftime(opened_at,'%Y%m%d%H%M%S%g')")} AS session_id
FROM (SELECT opened_at, unnest(ids) AS event_id, generate_subscripts(ids, 1) AS place
      FROM (SELECT o.anonymous_id, o.opened_at, list(e.event_id ORDER BY e.occurred_at, e.event_id) AS ids
            FROM stg e ASOF JOIN ({opened}) o
            ON e.anonymous_id = o.anonymous_id AND e.occurred_at >= o.opened_at GROUP BY 1, 2))
JOIN stg USING (event_id)"""


# --- fixed values: labels of channels -------------------------------------------
CHANNEL = """CASE WHEN utm_medium IN ('cpc','ppc','paid_search') THEN 'paid_search'
 WHEN utm_medium = 'paid_social' THEN 'paid_social' WHEN utm_medium = 'social' THEN 'organic_social'
 WHEN utm_medium = 'email' THEN 'email' WHEN utm_medium = 'organic' THEN 'organic_search'
 WHEN utm_medium = 'referral' THEN 'referral'
 WHEN utm_source IS NULL AND utm_medium IS NULL THEN 'direct' ELSE 'other' END"""
# --- end of fixed values ----------------------------------------------------------


def _first(column: str, keep: str = "", order: str = "event_seq_in_session") -> str:
    where = f" FILTER (WHERE {keep})" if keep else ""
    return f"(array_agg({column} ORDER BY {order}){where})[1]"


def _picked(columns: list[str], prefix: str = "", order: str = "event_seq_in_session") -> str:
    return ", ".join(f"{_first(c, order=order)} AS {prefix}{c}" for c in columns)


CONTEXT = ["device_type", "browser", "os", "country", "utm_source", "utm_medium", "utm_campaign"]

CTES: dict[str, str] = {
    "stg": adapter.staged_sql(DUCK),
    "raw": f"SELECT *, {adapter._fill(adapter.PAYLOAD, DUCK)} AS payload "
           f"FROM ({adapter.staged_sql(DUCK, kept=True)})",
    "msg": adapter.messages_sql(DUCK),
    "delivered": f"""
SELECT CAST(kafka_partition AS BIGINT) AS kafka_partition, kafka_offset, anonymous_id AS sent_by, sent, bad_bytes, batch_id FROM msg
UNION ALL
SELECT kafka_partition, kafka_offset + {adapter.REDELIVERY_OFFSET}, anonymous_id, sent, bad_bytes, batch_id + 1
FROM msg WHERE event_type = 'view'""",
    "parsed": """
SELECT *, js->>'$.event_id' AS p_id, js->>'$.event_name' AS p_name, js->>'$.anonymous_id' AS p_visitor,
  js->>'$.occurred_at' AS p_at, js->>'$.product.product_id' AS p_product, js->>'$.order.order_id' AS p_order,
  json_type(js,'$.order.revenue_usd') AS p_revenue_type, js->>'$.order.revenue_usd' AS p_revenue,
  coalesce(try_cast(left(js->>'$.occurred_at', 26) AS TIMESTAMP)
      - CASE WHEN js->>'$.occurred_at' LIKE '%+02:00' THEN INTERVAL '2' HOUR ELSE INTERVAL '0' HOUR END,
    try_strptime(js->>'$.occurred_at','%Y%m%dT%H%M%S.%f')) AS p_ts,
  try_cast(trim(js->>'$.event_id','{}') AS UUID) AS p_uuid
FROM (SELECT *, CASE WHEN NOT bad_bytes AND json_valid(sent) THEN sent END AS js FROM delivered)""",
    "judged": """
SELECT *, CASE WHEN bad_bytes THEN 'message value is not UTF-8'
 WHEN sent IS NULL THEN 'message value is empty (tombstone?)'
 WHEN js IS NULL THEN 'message value is not valid JSON'
 WHEN json_type(js) = 'ARRAY' THEN 'expected a JSON object, got list'
 WHEN coalesce(trim(p_name),'') = '' THEN 'missing required field ''event_name'''
 WHEN p_name NOT IN ('page_view','product_view','add_to_cart','checkout_start','purchase','search')
   THEN 'unknown event_name '''||p_name||''''
 WHEN coalesce(trim(p_id),'') = '' THEN 'missing required field ''event_id'''
 WHEN p_uuid IS NULL THEN 'event_id is not a UUID: '''||p_id||''''
 WHEN coalesce(trim(p_visitor),'') = '' THEN 'missing required field ''anonymous_id'''
 WHEN coalesce(trim(p_at),'') = '' THEN 'missing required field ''occurred_at'''
 WHEN p_ts IS NULL THEN 'occurred_at is not ISO-8601: '''||p_at||''''
 WHEN p_name IN ('product_view','add_to_cart') AND coalesce(p_product,'') = ''
   THEN p_name||' requires product.product_id'
 WHEN p_name = 'purchase' AND coalesce(p_order,'') = '' THEN 'purchase requires order.order_id'
 WHEN p_name = 'purchase' AND (p_revenue_type IS NULL OR p_revenue_type = 'VARCHAR'
      OR try_cast(p_revenue AS DOUBLE) < 0)
   THEN 'purchase requires a non-negative order.revenue_usd, got '||CASE p_revenue_type
     WHEN 'VARCHAR' THEN chr(39)||p_revenue||chr(39) ELSE coalesce(p_revenue, 'None') END
 END AS error FROM parsed""",
    "winners": """
SELECT CAST(p_uuid AS VARCHAR) AS event_id, p_name AS event_name, p_visitor AS anonymous_id, p_ts AS occurred_at,
  kafka_partition, kafka_offset, batch_id
FROM judged WHERE error IS NULL
QUALIFY row_number() OVER (PARTITION BY p_uuid ORDER BY kafka_offset, kafka_partition) = 1""",
    "batches": """
SELECT g.batch_id, messages_read, coalesce(stored,0) AS rows_inserted,
  valid - coalesce(stored,0) AS rows_duplicate, messages_read - valid AS rows_rejected
FROM (SELECT batch_id, count(*) AS messages_read, count(*) FILTER (WHERE error IS NULL) AS valid
      FROM judged GROUP BY 1) g
LEFT JOIN (SELECT batch_id, count(*) AS stored FROM winners GROUP BY 1) s USING (batch_id)""",
    "ses": _sessionized(1440),
    "ses30": _sessionized(30),
    "sessions": f"""
SELECT session_id, anonymous_id, {_uuid("anonymous_id")} AS visitor_key, user_id, started_at, ended_at,
  CAST(started_at AS DATE) AS session_date, {_seconds("ended_at", "started_at")} AS duration_seconds,
  events, n['page_view'] AS page_views, pages AS unique_pages, n['search'] AS searches,
  n['page_view'] < 2 AND events = n['page_view'] + n['search'] AS is_bounce,
  n['product_view'] > 0 AS viewed_product, n['add_to_cart'] > 0 AS added_to_cart,
  n['checkout_start'] > 0 AS started_checkout, n['purchase'] > 0 AS purchased,
  products AS products_viewed, orders, revenue_usd, {", ".join(f"opening.{c}" for c in CONTEXT)},
  landing_referrer, entry_page_path, exit_page_path, {CHANNEL.replace("utm_", "opening.utm_")} AS channel
FROM (SELECT session_id, any_value(anonymous_id) AS anonymous_id, any_value(session_started_at) AS started_at,
    max(occurred_at) AS ended_at, count(*) AS events,
    struct_pack({", ".join(f"{e} := count_if(event_name = '{e}')" for e in schema.EVENT_NAMES)}) AS n,
    coalesce(len(list_distinct(list(page_path) FILTER (WHERE event_name = 'page_view'))),0) AS pages,
    coalesce(len(list_distinct(list(product_id) FILTER (WHERE event_name = 'product_view'))),0) AS products,
    coalesce(len(list_distinct(list(order_id))),0) AS orders,
    coalesce(sum(CAST(order_revenue_usd AS DECIMAL(28,2))),0) AS revenue_usd,
    arg_max(user_id, event_seq_in_session) AS user_id,
    arg_min(struct_pack({", ".join(f"{c} := {c}" for c in CONTEXT)}), event_seq_in_session) AS opening,
    arg_min(referrer, event_seq_in_session) AS landing_referrer,
    arg_min_null(page_path, event_seq_in_session) FILTER (WHERE event_name = 'page_view') AS entry_page_path,
    arg_max_null(page_path, event_seq_in_session) FILTER (WHERE event_name = 'page_view') AS exit_page_path
  FROM ses GROUP BY session_id)""",
    "views": f"""
SELECT ses.event_id AS page_view_id, ses.session_id, anonymous_id, {_uuid("anonymous_id")} AS visitor_key,
  {_uuid("page_path")} AS page_key, user_id, occurred_at, CAST(occurred_at AS DATE) AS view_date,
  place AS page_view_seq, page_path, page_title, page_type, referrer, device_type, browser, os, country,
  place = 1 AS is_entry_page, place = len(trail) AS is_exit_page,
  CASE WHEN place < len(trail) THEN {_seconds("trail[place + 1].at", "occurred_at")} END AS seconds_on_page
FROM (SELECT trail, unnest(range(1, len(trail) + 1)) AS place
      FROM (SELECT list(struct_pack(at := occurred_at, id := event_id) ORDER BY occurred_at, event_id) AS trail
            FROM ses WHERE event_name = 'page_view' AND page_path IS NOT NULL GROUP BY session_id))
JOIN ses ON ses.event_id = trail[place].id""",
    "visitors": f"""
SELECT {_uuid("anonymous_id")} AS visitor_key, anonymous_id,
  {_first("user_id", "user_id IS NOT NULL", "occurred_at DESC, event_id DESC")} AS user_id,
  bool_or(user_id IS NOT NULL) AS is_identified, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,
  count(*) AS lifetime_events, count(*) FILTER (WHERE event_name = 'page_view') AS lifetime_page_views,
  count(DISTINCT order_id) AS lifetime_orders,
  CAST(coalesce(sum(order_revenue_usd),0) AS DECIMAL(28,2)) AS lifetime_revenue_usd,
  {_picked(CONTEXT, "first_", "occurred_at, event_id")}
FROM stg GROUP BY anonymous_id""",
    "title_mode": """
SELECT page_path, page_title FROM stg WHERE event_name = 'page_view' AND page_path IS NOT NULL AND page_title IS NOT NULL
GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY page_path ORDER BY count(*) DESC, page_title) = 1""",
    "type_mode": """
SELECT page_path, page_type FROM stg WHERE event_name = 'page_view' AND page_path IS NOT NULL AND page_type IS NOT NULL
GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY page_path ORDER BY count(*) DESC, page_type) = 1""",
    "pages_dim": f"""
SELECT {_uuid("page_path")} AS page_key, page_path, page_title, page_type, lifetime_page_views, lifetime_visitors,
  first_seen_at, last_seen_at
FROM (SELECT page_path, count(*) AS lifetime_page_views, count(DISTINCT anonymous_id) AS lifetime_visitors,
        min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at
      FROM stg WHERE event_name = 'page_view' AND page_path IS NOT NULL GROUP BY 1)
LEFT JOIN title_mode USING (page_path) LEFT JOIN type_mode USING (page_path)""",
    "name_mode": """
SELECT product_id, product_name FROM stg WHERE product_id IS NOT NULL AND product_name IS NOT NULL
GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, product_name) = 1""",
    "category_mode": """
SELECT product_id, product_category AS category FROM stg WHERE product_id IS NOT NULL AND product_category IS NOT NULL
GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, product_category) = 1""",
    "products": f"""
SELECT {_uuid("product_id")} AS product_key, product_id, product_name, category, latest_price_usd, min_price_usd,
  max_price_usd, lifetime_product_views, lifetime_add_to_carts, lifetime_units_added, first_seen_at, last_seen_at
FROM (SELECT product_id,
        {_first("product_price_usd", "product_price_usd IS NOT NULL", "occurred_at DESC, event_id DESC")}
          AS latest_price_usd,
        min(product_price_usd) AS min_price_usd, max(product_price_usd) AS max_price_usd,
        count(*) FILTER (WHERE event_name = 'product_view') AS lifetime_product_views,
        count(*) FILTER (WHERE event_name = 'add_to_cart') AS lifetime_add_to_carts,
        coalesce(sum(quantity) FILTER (WHERE event_name = 'add_to_cart'),0) AS lifetime_units_added,
        min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at
      FROM stg WHERE product_id IS NOT NULL GROUP BY 1)
LEFT JOIN name_mode USING (product_id) LEFT JOIN category_mode USING (product_id)""",
    "steps": f"""
SELECT generate_subscripts(names, 1) AS step_index, unnest(names) AS step_name
FROM (SELECT string_split('{STEPS}', ',') AS names)""",
    "hits": """
SELECT session_id, event_name, min(occurred_at) AS reached_at FROM ses
WHERE event_name IN (SELECT step_name FROM steps) GROUP BY 1, 2""",
    "funnel": f"""
SELECT session_id, step_index, split_part('{STEPS}', ',', CAST(step_index AS INT)) AS step_name,
  times[step_index] AS reached_at, started_at AS session_started_at, session_date, channel,
  device_type, country, anonymous_id, revenue_usd AS session_revenue_usd,
  {_seconds("times[step_index]", "started_at")} AS seconds_from_session_start,
  step_index = depth AS is_final_step
FROM (SELECT session_id, times, depth, unnest(range(1, depth + 1)) AS step_index
      FROM (SELECT session_id, times, CASE {" ".join(
          f"WHEN times[{k}] IS NULL" + (f" OR times[{k}] < times[{k - 1}]" if k > 1 else "") + f" THEN {k - 1}"
          for k in range(1, len(schema.FUNNEL_STEPS) + 1))} ELSE {len(schema.FUNNEL_STEPS)} END AS depth
        FROM (SELECT session_id, [{", ".join(
          f"min(CASE event_name WHEN '{e}' THEN occurred_at END)" for e in schema.FUNNEL_STEPS)}] AS times
          FROM ses GROUP BY 1)))
JOIN sessions USING (session_id)""",
    "reach": " UNION ALL ".join(f"""
SELECT {label} AS channel, step_index, any_value(step_name) AS step_name, count(*) AS sessions_reached,
  len(list_distinct(list(anonymous_id))) AS visitors_reached,
  coalesce(sum(CAST(is_final_step AS BIGINT)),0) AS sessions_stopped_here,
  {_rounded("sum(seconds_from_session_start)", "count(*)", 1)} AS avg_seconds_to_reach,
  CAST(sum(CASE step_name WHEN 'purchase' THEN session_revenue_usd ELSE 0 END) AS DOUBLE) AS revenue_usd
FROM funnel GROUP BY {keys}""" for label, keys in (
        ("channel", "channel, step_index"), (f"'{schema.ALL_CHANNELS}'", "step_index"))),
    "conversion": f"""
SELECT r.channel, r.step_index, r.step_name, r.sessions_reached, r.visitors_reached,
  entry.sessions_reached AS sessions_entered, before.sessions_reached AS prev_step_sessions,
  coalesce(before.sessions_reached - r.sessions_reached, 0) AS sessions_lost,
  CAST(r.sessions_stopped_here AS BIGINT) AS sessions_stopped_here,
  {_pct("r.sessions_reached", "before.sessions_reached")} AS step_conversion_pct,
  {_pct("r.sessions_reached", "entry.sessions_reached")} AS overall_conversion_pct,
  {_pct("before.sessions_reached - r.sessions_reached", "before.sessions_reached")} AS step_dropoff_pct,
  r.avg_seconds_to_reach, r.revenue_usd
FROM reach r JOIN reach entry ON entry.channel = r.channel AND entry.step_index = 1
LEFT JOIN reach before ON before.channel = r.channel AND before.step_index = r.step_index - 1""",
    "daily": f"""
SELECT day AS session_date, channel, device_type, n AS sessions, visitors, s.events, s.page_views, s.searches,
  s.bounced AS bounced_sessions, s.viewed AS sessions_viewed_product, s.added AS sessions_added_to_cart,
  s.started AS sessions_started_checkout, s.bought AS sessions_purchased, s.orders, s.usd AS revenue_usd,
  {_pct("s.bounced", "n")} AS bounce_rate_pct, {_pct("s.bought", "n")} AS conversion_rate_pct,
  {_rounded("s.seconds", "n", 1)} AS avg_session_seconds, {_rounded("s.page_views", "n", 2)} AS avg_page_views,
  {_rounded(_cents("s.usd"), "n", 0)}/100.0 AS revenue_per_session_usd,
  {_rounded(_cents("s.usd"), "s.orders", 0)}/100.0 AS avg_order_value_usd
FROM (SELECT session_date AS day, channel, device_type, count(*) AS n,
    len(list_distinct(list(anonymous_id))) AS visitors, struct_pack({", ".join(
      f"{name} := CAST(sum({what}) AS {kind})" for name, what, kind in (
        ("events", "events", "BIGINT"), ("page_views", "page_views", "BIGINT"),
        ("searches", "searches", "BIGINT"), ("bounced", "CAST(is_bounce AS INT)", "BIGINT"),
        ("viewed", "CAST(viewed_product AS INT)", "BIGINT"), ("added", "CAST(added_to_cart AS INT)", "BIGINT"),
        ("started", "CAST(started_checkout AS INT)", "BIGINT"), ("bought", "CAST(purchased AS INT)", "BIGINT"),
        ("orders", "orders", "BIGINT"), ("seconds", "duration_seconds", "BIGINT"),
        ("usd", "revenue_usd", "DECIMAL(28,2)")))}) AS s
  FROM sessions GROUP BY 1, 2, 3)""",
}

# What each relation is built from.
NEEDS: dict[str, list[str]] = {
    "delivered": ["msg"], "parsed": ["delivered"], "judged": ["parsed"], "winners": ["judged"],
    "batches": ["winners"], "ses": ["stg"], "ses30": ["stg"], "sessions": ["ses"], "views": ["ses"],
    "visitors": ["stg"], "title_mode": ["stg"], "type_mode": ["stg"], "pages_dim": ["title_mode", "type_mode"],
    "name_mode": ["stg"], "category_mode": ["stg"], "products": ["name_mode", "category_mode"],
    "hits": ["ses", "steps"], "funnel": ["sessions"], "reach": ["funnel"], "conversion": ["reach"],
    "daily": ["sessions"],
}


def _query(body: str, *needs: str, **extra: str) -> str:
    """`body` with the relations it needs in front; `extra` relations come last."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS.get(name, []):
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name]})" for name in ordered]
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _plain(columns: str, table: str, *needs: str) -> str:
    return _query(f"SELECT {columns} FROM {table}", *(needs or (table,)))


# relation of a check -> relation here
RELATIONS = {
    "stg_events": "stg",
    "int_sessionized_events": "ses",
    "dim_visitor": "visitors",
    "dim_page": "pages_dim",
    "dim_product": "products",
    "fct_sessions": "sessions",
    "fct_page_views": "views",
    "fct_funnel_steps": "funnel",
    "agg_daily_traffic": "daily",
    "agg_funnel_conversion": "conversion",
}


def broken_rows(check: Check) -> str:
    """Scalar SQL counting the rows that break a check."""
    table = RELATIONS[check.model]
    if check.kind == "not_null":
        return f"(SELECT count(*) - count({check.column}) FROM {table})"
    if check.kind == "unique":
        return f"(SELECT count({check.column}) - count(DISTINCT {check.column}) FROM {table})"
    if check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.values)
        return f"(SELECT count(*) FROM {table} WHERE {check.column} NOT IN ({listed}))"
    if check.kind == "relationships":
        return (
            f"(SELECT count(*) FROM {table} LEFT JOIN (SELECT DISTINCT {check.parent_column} AS found "
            f"FROM {RELATIONS[check.parent]}) ON found = {check.column} "
            f"WHERE {check.column} IS NOT NULL AND found IS NULL)"
        )
    if check.kind == "unique_combination":
        keys = ", ".join(check.columns)
        return f"((SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table})))"
    return f"(SELECT count(*) FROM {table} WHERE ({check.expression}) IS NOT TRUE)"


def _checks_sql() -> str:
    rows = []
    for check in CHECKS:
        column = f"'{check.column}'" if check.column else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT '{check.model}' AS model_name, {column} AS column_name, '{check.kind}' AS test_name, "
            f"CAST({broken_rows(check)} AS BIGINT) AS failing_rows"
        )
    union = " UNION ALL ".join(rows)
    return f"SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({union})"


COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS relation, (SELECT count(*) FROM {RELATIONS[name.split('.')[1]]}) AS row_count"
    for name in schema.RELATIONS
)
ALL_RELATIONS = tuple(RELATIONS.values())

EVENT = "event_id, event_name, anonymous_id, occurred_at"
JUDGED = ("kafka_partition, kafka_offset, error, CASE WHEN error IS NULL THEN CAST(p_uuid AS VARCHAR) END AS event_id, "
          "CASE WHEN error IS NULL THEN p_name END AS event_name, "
          "CASE WHEN error IS NULL THEN p_visitor END AS anonymous_id, "
          "CASE WHEN error IS NULL THEN p_ts END AS occurred_at")
STG = """* REPLACE (CAST(product_price_usd AS DOUBLE) AS product_price_usd, CAST(quantity AS BIGINT) AS quantity,
 CAST(search_results_count AS BIGINT) AS search_results_count, CAST(cart_value_usd AS DOUBLE) AS cart_value_usd,
 CAST(cart_item_count AS BIGINT) AS cart_item_count, CAST(order_revenue_usd AS DOUBLE) AS order_revenue_usd,
 CAST(order_shipping_usd AS DOUBLE) AS order_shipping_usd, CAST(order_item_count AS BIGINT) AS order_item_count)"""
MONEY = "* REPLACE (CAST(revenue_usd AS DOUBLE) AS revenue_usd)"
BRIDGE = f"{EVENT.replace(', event_name', '')}, session_started_at, event_seq_in_session, session_id"


def oracle_sql() -> dict[str, str]:
    title = "'stale' AS page_title"
    target = f"SELECT * REPLACE ({title}) FROM stg WHERE ingested_at < TIMESTAMP '2024-01-21'"
    floor = "(SELECT max(ingested_at) - INTERVAL '15' MINUTE FROM target)"
    return {
        # ingest
        "validate_events": _plain(JUDGED, "judged"),
        "dead_letters": _query(
            "SELECT batch_id, kafka_partition, kafka_offset, sent_by AS message_key, error, "
            "CASE WHEN bad_bytes THEN chr(65533)||chr(65533)||'\\x00' ELSE sent END AS message_value "
            "FROM judged WHERE error IS NOT NULL", "judged"),
        "clean_reject_text": "SELECT doc_id, replace(text, chr(0), '\\x00') AS message_value, "
                             "substr(replace(text, chr(0), '\\x00'),1,8000) AS limited_value, "
                             "substr(replace(text, chr(0), '\\x00'),1,512) AS message_key FROM documents",
        "dedup_first_offset": _plain("*", "winners"),
        "land_anti_join": _query(
            f"SELECT {EVENT}, kafka_partition, kafka_offset FROM winners WHERE event_id NOT IN "
            "(SELECT event_id FROM stg WHERE occurred_at < TIMESTAMP '2024-01-16')", "winners", "stg"),
        "ingest_batch_stats": _query(
            "SELECT b.*, '{'||(SELECT string_agg('\"'||kafka_partition||'\":'||top, ',' ORDER BY kafka_partition) "
            "FROM (SELECT kafka_partition, max(kafka_offset) AS top FROM judged j WHERE j.batch_id = b.batch_id "
            "GROUP BY 1))||'}' AS offsets FROM batches b", "batches"),
        "max_offset_per_partition": _query(
            "SELECT kafka_partition, max(kafka_offset) AS max_offset, max(kafka_offset) + 1 AS resume_offset "
            "FROM delivered GROUP BY 1", "delivered"),
        "publish_projection": _query(
            "SELECT p_visitor AS key, sent AS value, p_ts AS occurred_at FROM judged "
            "WHERE error IS NULL AND kafka_offset < 1000000000", "judged"),
        "publish_counts": _query(
            "SELECT count(*) FILTER (WHERE error IS NULL) AS produced, count(error) AS invalid "
            "FROM judged WHERE kafka_offset < 1000000000", "judged"),
        "json_lines_ingest": _plain(EVENT, "stg"),
        # staging
        "stg_events_flatten": _plain(STG, "stg"),
        "incremental_overlap_slice": _query(
            f"SELECT {EVENT}, ingested_at FROM stg WHERE ingested_at >= {floor}", "stg", target=target),
        "incremental_upsert": _query(
            f"SELECT {EVENT}, page_title, ingested_at FROM stg WHERE ingested_at >= {floor} UNION ALL "
            f"SELECT {EVENT}, page_title, ingested_at FROM target WHERE event_id NOT IN "
            f"(SELECT event_id FROM stg WHERE ingested_at >= {floor})", "stg", target=target),
        "stored_upsert": _query(
            f"SELECT {EVENT}, page_title, ingested_at FROM stg WHERE ingested_at >= {floor} UNION ALL "
            f"SELECT {EVENT}, page_title, ingested_at FROM target WHERE event_id NOT IN "
            f"(SELECT event_id FROM stg WHERE ingested_at >= {floor})", "stg", target=target),
        "surrogate_keys": _query(
            f"SELECT event_id, {_uuid('anonymous_id')} AS visitor_key, {_uuid('page_path')} AS page_key, "
            f"{_uuid('product_id')} AS product_key FROM stg", "stg"),
        "channel_grouping": _query(f"SELECT event_id, {CHANNEL} AS channel FROM stg", "stg"),
        "event_name_counts": _query("SELECT event_name, count(*) AS events FROM stg GROUP BY 1", "stg"),
        # sessions
        "sessionize_gap": _plain(BRIDGE, "ses"),
        "sessionize_gap_30_minutes": _plain(BRIDGE, "ses30"),
        "late_events_recut": _plain(BRIDGE, "ses"),
        "bridge_join": _plain(
            f"{EVENT}, session_id, session_started_at, event_seq_in_session, page_path", "ses"),
        "fct_sessions": _plain(MONEY, "sessions"),
        "fct_page_views": _plain("*", "views"),
        "daily_traffic": _plain(MONEY, "daily"),
        # dimensions
        "dim_visitor": _plain(
            "* REPLACE (CAST(lifetime_revenue_usd AS DOUBLE) AS lifetime_revenue_usd)", "visitors"),
        "dim_visitor_from_sessions": _plain(
            "* REPLACE (CAST(lifetime_revenue_usd AS DOUBLE) AS lifetime_revenue_usd)", "visitors"),
        "dim_page": _plain("*", "pages_dim"),
        "dim_product": _plain(
            "* REPLACE (CAST(latest_price_usd AS DOUBLE) AS latest_price_usd, "
            "CAST(min_price_usd AS DOUBLE) AS min_price_usd, CAST(max_price_usd AS DOUBLE) AS max_price_usd, "
            "CAST(lifetime_units_added AS BIGINT) AS lifetime_units_added)", "products"),
        # funnel
        "funnel_step_list": _query(
            "SELECT step_index, step_name, count(event_id) AS events FROM steps "
            "LEFT JOIN stg ON event_name = step_name GROUP BY 1, 2", "steps", "stg"),
        "funnel_semi_filter": _query(
            "SELECT event_id, event_name FROM stg WHERE event_name IN (SELECT step_name FROM steps)", "stg", "steps"),
        "funnel_first_hit": _plain("*", "hits"),
        "funnel_steps": _plain(
            "* REPLACE (CAST(session_revenue_usd AS DOUBLE) AS session_revenue_usd)", "funnel"),
        "funnel_steps_from_stored": _plain(
            "* REPLACE (CAST(session_revenue_usd AS DOUBLE) AS session_revenue_usd)", "funnel"),
        "funnel_grouping_sets": _plain("*", "reach"),
        "funnel_conversion": _plain("*", "conversion"),
        # reports
        "report_funnel": _query(
            "SELECT step_index, step_name, sessions_reached, sessions_lost, step_conversion_pct, "
            "overall_conversion_pct, avg_seconds_to_reach, revenue_usd FROM conversion "
            f"WHERE channel = '{schema.ALL_CHANNELS}'", "conversion"),
        "report_funnel_channels": _query("SELECT DISTINCT channel FROM conversion", "conversion"),
        "report_traffic": _query(
            "SELECT session_date, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(visitors) AS BIGINT) AS visitors, "
            "CAST(sum(page_views) AS BIGINT) AS page_views, "
            f"{_pct('sum(bounced_sessions)', 'sum(sessions)')} AS bounce_rate_pct, "
            f"{_pct('sum(sessions_purchased)', 'sum(sessions)')} AS conversion_rate_pct, "
            "CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(revenue_usd) AS DOUBLE) AS revenue_usd, "
            f"{_rounded('sum(CAST(round(avg_session_seconds*10) AS BIGINT)*sessions)', 'sum(sessions)', 0)}/10.0 "
            "AS avg_session_seconds FROM daily GROUP BY 1 ORDER BY 1 DESC LIMIT 14", "daily"),
        "report_channels": _query(
            "SELECT channel, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(visitors) AS BIGINT) AS visitors, "
            f"{_pct('sum(sessions_purchased)', 'sum(sessions)')} AS conversion_rate_pct, "
            f"{_pct('sum(bounced_sessions)', 'sum(sessions)')} AS bounce_rate_pct, "
            "CAST(sum(revenue_usd) AS DOUBLE) AS revenue_usd, "
            f"{_rounded(_cents('sum(revenue_usd)'), 'sum(sessions)', 0)}/100.0 AS revenue_per_session_usd "
            "FROM daily GROUP BY 1", "daily"),
        "top_pages": _query(
            "SELECT v.page_path, d.page_type, count(*) AS views, count(DISTINCT session_id) AS sessions, "
            "count(*) FILTER (WHERE is_entry_page) AS entries, count(*) FILTER (WHERE is_exit_page) AS exits, "
            f"{_rounded('sum(seconds_on_page)', 'count(seconds_on_page)', 1)} AS avg_seconds, "
            f"{_pct('count(*) FILTER (WHERE is_exit_page)', 'count(*)', 1)} AS exit_rate_pct "
            "FROM views v JOIN pages_dim d USING (page_path) GROUP BY 1, 2 ORDER BY views DESC, page_path LIMIT 15",
            "views", "pages_dim"),
        "top_products": _query(
            "SELECT product_id, product_name, category, CAST(latest_price_usd AS DOUBLE) AS price, "
            "lifetime_product_views AS views, lifetime_add_to_carts AS carts, "
            f"{_pct('lifetime_add_to_carts', 'lifetime_product_views', 1)} AS cart_rate_pct "
            "FROM products ORDER BY views DESC, product_id LIMIT 10", "products"),
        "recent_batches": _query(
            "SELECT batch_id, 'committed' AS status, TIMESTAMP '2024-01-01' + CAST(batch_id AS INT) * INTERVAL '1' DAY "
            "AS started_at, messages_read, rows_inserted, rows_duplicate, rows_rejected, CAST(NULL AS VARCHAR) AS error "
            "FROM batches ORDER BY batch_id DESC LIMIT 5", "batches"),
        "ingest_overview": _query(
            "SELECT count(*) AS events, count(DISTINCT anonymous_id) AS visitors, min(occurred_at) AS first_event_at, "
            "max(occurred_at) AS last_event_at, max(ingested_at) AS last_ingested_at, "
            "(SELECT count(*) FROM judged WHERE error IS NOT NULL) AS dead_letters FROM stg", "stg", "judged"),
        "table_counts": _query(
            f"{COUNTS} UNION ALL SELECT 'mart.not_built', NULL", *ALL_RELATIONS),
        "last_transform_run": _query(
            "SELECT count(*) AS models, count(row_count) AS succeeded, CAST(0 AS BIGINT) AS failed, "
            "CAST(0 AS BIGINT) AS skipped FROM counts", *ALL_RELATIONS, counts=COUNTS),
        "failed_transform_run": _query(
            "SELECT split_part(relation, '.', 2) AS model_name, CASE relation WHEN 'stg.stg_events' THEN 'failed' "
            "ELSE 'skipped' END AS status, CAST(NULL AS BIGINT) AS rows_affected FROM counts",
            *ALL_RELATIONS, counts=COUNTS),
        "last_test_run": _query(
            "SELECT count(*) AS tests, count(*) FILTER (WHERE failing_rows = 0) AS passed, "
            "count(*) FILTER (WHERE failing_rows > 0) AS failed, CAST(0 AS BIGINT) AS errored FROM results",
            *ALL_RELATIONS, results=_checks_sql()),
        "failing_tests": _query(
            "SELECT model_name, column_name, test_name, status, failing_rows, CAST(NULL AS VARCHAR) AS error "
            "FROM results WHERE failing_rows > 0", *ALL_RELATIONS, results=_checks_sql()),
        # quality
        "dq_not_null": _query("SELECT count(*) AS failing_rows FROM stg WHERE page_path IS NULL", "stg"),
        "dq_unique": _query(
            "SELECT CAST(sum(n - 1) AS BIGINT) AS failing_rows FROM (SELECT count(*) AS n FROM stg "
            "WHERE product_id IS NOT NULL GROUP BY product_id)", "stg"),
        "dq_accepted_values": _query(
            "SELECT count(*) AS failing_rows FROM stg WHERE utm_medium NOT IN ('organic', 'email')", "stg"),
        "dq_relationships": _query(
            "SELECT count(*) AS failing_rows FROM stg s WHERE product_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM stg p WHERE p.event_name = 'add_to_cart' AND p.product_name = s.product_name)", "stg"),
        "dq_unique_combination": _query(
            "SELECT CAST(sum(n - 1) AS BIGINT) AS failing_rows FROM (SELECT count(*) AS n FROM stg "
            "GROUP BY anonymous_id, utm_source)", "stg"),
        "dq_assert_expression": _query(
            "SELECT count(*) AS failing_rows FROM stg WHERE (product_price_usd > 20) IS NOT TRUE", "stg"),
        "dq_suite": _query(
            "SELECT model_name, column_name, test_name, status, failing_rows, CAST(NULL AS VARCHAR) AS error "
            "FROM results", *ALL_RELATIONS, results=_checks_sql()),
    }
