"""The declared checks of the built relations (fixed values)."""

from __future__ import annotations

from footfall import schema
from footfall.operators.quality import Check


def _model(
    model: str,
    asserts: tuple[str, ...] = (),
    grain: tuple[str, ...] = (),
    not_null: tuple[str, ...] = (),
    unique: tuple[str, ...] = (),
    accepted: dict[str, list[str]] | None = None,
    parents: dict[str, tuple[str, str]] | None = None,
) -> list[Check]:
    checks = [Check(model, "assert_expression", expression=e) for e in asserts]
    if grain:
        checks.append(Check(model, "unique_combination", columns=grain))
    checks += [Check(model, "not_null", c) for c in not_null]
    checks += [Check(model, "unique", c) for c in unique]
    checks += [
        Check(model, "accepted_values", c, values=tuple(v)) for c, v in (accepted or {}).items()
    ]
    checks += [
        Check(model, "relationships", c, parent=parent, parent_column=column)
        for c, (parent, column) in (parents or {}).items()
    ]
    return checks


CHECKS: list[Check] = [
    *_model(
        "stg_events",
        asserts=(
            "event_name not in ('product_view', 'add_to_cart') or product_id is not null",
            "event_name <> 'purchase' or order_id is not null",
            "product_price_usd is null or product_price_usd > 0",
            "order_revenue_usd is null or order_revenue_usd >= 0",
            "quantity is null or quantity > 0",
        ),
        not_null=("event_id", "event_name", "anonymous_id", "occurred_at", "ingested_at"),
        unique=("event_id",),
        accepted={"event_name": schema.EVENT_NAMES, "device_type": schema.DEVICE_TYPES},
    ),
    *_model(
        "int_sessionized_events",
        asserts=("occurred_at >= session_started_at", "event_seq_in_session >= 1"),
        grain=("session_id", "event_seq_in_session"),
        not_null=("event_id", "session_id", "anonymous_id", "session_started_at"),
        unique=("event_id",),
        parents={"event_id": ("stg_events", "event_id")},
    ),
    *_model(
        "dim_visitor",
        asserts=(
            "last_seen_at >= first_seen_at",
            "lifetime_revenue_usd >= 0",
            "lifetime_page_views <= lifetime_events",
        ),
        not_null=("visitor_key", "anonymous_id"),
        unique=("visitor_key", "anonymous_id"),
        accepted={"first_device_type": schema.DEVICE_TYPES},
    ),
    *_model(
        "dim_page",
        asserts=("lifetime_visitors <= lifetime_page_views", "page_path like '/%'"),
        not_null=("page_key", "page_path", "page_title"),
        unique=("page_key", "page_path"),
    ),
    *_model(
        "dim_product",
        asserts=("latest_price_usd > 0", "max_price_usd >= min_price_usd"),
        not_null=("product_key", "product_id", "category"),
        unique=("product_key", "product_id"),
    ),
    *_model(
        "fct_sessions",
        asserts=(
            "ended_at >= started_at",
            "duration_seconds >= 0",
            "events > 0",
            "purchased or revenue_usd = 0",
            "not purchased or revenue_usd > 0",
            "(orders > 0) = purchased",
            "not is_bounce or page_views <= 1",
            "unique_pages <= page_views",
        ),
        not_null=("session_id", "anonymous_id", "started_at", "session_date", "channel"),
        unique=("session_id",),
        accepted={"channel": schema.CHANNELS},
        parents={"anonymous_id": ("dim_visitor", "anonymous_id")},
    ),
    *_model(
        "fct_page_views",
        asserts=(
            "seconds_on_page is null or seconds_on_page >= 0",
            "page_view_seq >= 1",
            "seconds_on_page is not null or is_exit_page",
        ),
        grain=("session_id", "page_view_seq"),
        not_null=("page_view_id", "session_id", "page_path", "occurred_at"),
        unique=("page_view_id",),
        parents={
            "session_id": ("fct_sessions", "session_id"),
            "page_path": ("dim_page", "page_path"),
        },
    ),
    *_model(
        "fct_funnel_steps",
        asserts=(
            "step_index between 1 and 5",
            "reached_at >= session_started_at",
            "seconds_from_session_start >= 0",
        ),
        grain=("session_id", "step_index"),
        not_null=("session_id", "step_name", "channel"),
        accepted={"step_name": schema.FUNNEL_STEPS},
        parents={"session_id": ("fct_sessions", "session_id")},
    ),
    *_model(
        "agg_daily_traffic",
        asserts=(
            "sessions > 0",
            "visitors <= sessions",
            "bounce_rate_pct between 0 and 100",
            "conversion_rate_pct between 0 and 100",
            "sessions_purchased <= sessions_started_checkout",
            "sessions_started_checkout <= sessions_added_to_cart",
            "sessions_added_to_cart <= sessions_viewed_product",
            "revenue_usd >= 0",
        ),
        grain=("session_date", "channel", "device_type"),
        not_null=("session_date", "channel"),
    ),
    *_model(
        "agg_funnel_conversion",
        asserts=(
            "overall_conversion_pct between 0 and 100",
            "step_conversion_pct is null or step_conversion_pct between 0 and 100",
            "sessions_reached <= sessions_entered",
            "prev_step_sessions is null or sessions_reached <= prev_step_sessions",
            "sessions_lost >= 0",
            "step_index = 1 or prev_step_sessions is not null",
        ),
        grain=("channel", "step_index"),
        not_null=("channel", "step_name", "sessions_reached"),
    ),
]
