"""Building all relations from landed events, in order, and testing them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import schema
from footfall.operators.dims import dim_page, dim_product, dim_visitor_from_sessions
from footfall.operators.funnel import funnel_conversion, funnel_steps
from footfall.operators.pageviews import fct_page_views
from footfall.operators.quality import Suite
from footfall.operators.sessions import bridge, fct_sessions, sessionize
from footfall.operators.slices import SLICE
from footfall.operators.staging import INGEST_DATE, flatten_events, incremental_slice
from footfall.operators.traffic import daily_traffic
from footfall.plans import warehouse
from footfall.plans.checks import CHECKS
from footfall.streaming.ingest import first_copies

# Events with their session columns, stored once for all that need them.
WIDE = "stg.sessionized_events"
STAGED = "stg.stg_events"


def marts(
    stg: DataFrame,
    timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES,
    steps: list[str] = schema.FUNNEL_STEPS,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, DataFrame]:
    """Every relation from staged events, by name.

    `keep(df, name)` may store a relation that several others read and return the
    stored one; by default all stay lazy.
    """
    sessionized = keep(sessionize(stg, timeout_minutes), "sessionized_events")
    with_times = keep(fct_sessions(sessionized, steps), "sessions_with_steps")
    funnel = keep(funnel_steps(with_times, steps), "fct_funnel_steps")
    sessions = with_times.drop("step_times")
    return {
        "stg_events": stg,
        "int_sessionized_events": bridge(sessionized),
        "dim_visitor": keep(dim_visitor_from_sessions(sessions, stg), "dim_visitor"),
        "dim_page": keep(dim_page(stg), "dim_page"),
        "dim_product": keep(dim_product(stg), "dim_product"),
        "fct_sessions": sessions,
        "fct_page_views": keep(fct_page_views(sessionized), "fct_page_views"),
        "fct_funnel_steps": funnel,
        "agg_daily_traffic": keep(daily_traffic(sessions), "agg_daily_traffic"),
        "agg_funnel_conversion": keep(funnel_conversion(funnel), "agg_funnel_conversion"),
    }


def newest_partition(spark: SparkSession) -> DataFrame:
    """Staged events of the latest ingest date, which hold the newest of all.

    The date comes from the catalog's list of partitions, one entry per day.
    """
    stored = spark.table(STAGED)
    days = [r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {STAGED}").collect()]
    return stored.where(F.col(INGEST_DATE) == max(days)) if days else stored


def build_models(
    spark: SparkSession,
    timeout_minutes: int = schema.SESSION_TIMEOUT_MINUTES,
    steps: list[str] = schema.FUNNEL_STEPS,
    full_refresh: bool = False,
    raw: DataFrame | None = None,
    ids: DataFrame | None = None,
) -> str:
    """Bring all tables up to date from `raw`; returns the run id in the log.

    `raw` holds the landed events, by default the table raw.events. With `ids`, the store's list of
    landed ids, an event that two streams landed at the same moment is staged once, whichever copy
    was seen first and on whatever days; without it, once if both copies are in the same slice.

    Staging is incremental. Sessions and what follows are rebuilt, because a late
    event can extend or join older sessions. A model that fails is logged and what
    needs it is logged as skipped.
    """
    warehouse.create_databases(spark)
    run_id = str(uuid.uuid4())
    unavailable: set[str] = set()

    def attempt(name: str, how: str, needs: tuple[str, ...], action: Callable[[], int]) -> None:
        started = warehouse.now()
        status, rows, error = "skipped", None, None
        if unavailable.isdisjoint(needs):
            try:
                rows, status = action(), "success"
            except Exception as problem:
                status, error = "failed", f"{type(problem).__name__}: {problem}"
        if status != "success":
            unavailable.add(name)
        warehouse.log_model_run(
            spark, run_id, name, how, status, started, rows, full_refresh, error
        )

    def table(name: str, df: Callable[[], DataFrame], needs: tuple[str, ...]) -> None:
        attempt(name, "table", needs, lambda: warehouse.materialize_table(df(), f"mart.{name}"))

    def staging() -> int:
        landed = spark.table("raw.events") if raw is None else raw
        fresh = full_refresh or not spark.catalog.tableExists(STAGED)
        slice_ = incremental_slice(landed, None if fresh else newest_partition(spark))
        later = None
        if ids is not None:
            slice_, later = first_copies(slice_, ids)
        return warehouse.upsert(
            dated(slice_),
            STAGED,
            ["event_id"],
            full_refresh,
            partition=INGEST_DATE,
            order=["ingested_at"],
            gone=None if later is None else dated(later),
        )

    def dated(rows: DataFrame) -> DataFrame:
        return flatten_events(rows).withColumn(INGEST_DATE, F.to_date("ingested_at"))

    def sessions_bridge() -> int:
        # written in the layout the page views and sessions read: no second shuffle
        layout = ["anonymous_id", SLICE]
        warehouse.materialize_table(
            sessionize(stg().drop(INGEST_DATE), timeout_minutes),
            WIDE,
            bucket_by=layout,
            sort_by=[*layout, "occurred_at", "event_id"],
        )
        names = ", ".join(bridge(spark.table(WIDE)).columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW stg.int_sessionized_events AS SELECT {names} FROM {WIDE}"
        )
        return spark.table(WIDE).count()

    def stg() -> DataFrame:
        return spark.table(STAGED)

    def wide() -> DataFrame:
        return spark.table(WIDE)

    def mart(name: str) -> DataFrame:
        return spark.table(f"mart.{name}")

    attempt("stg_events", "incremental", (), staging)
    attempt("int_sessionized_events", "table", ("stg_events",), sessions_bridge)
    bridged = ("int_sessionized_events",)
    table("dim_page", lambda: dim_page(stg()), ("stg_events",))
    table("dim_product", lambda: dim_product(stg()), ("stg_events",))
    table("fct_sessions", lambda: fct_sessions(wide(), steps), bridged)
    table(
        "dim_visitor",
        lambda: dim_visitor_from_sessions(mart("fct_sessions"), stg()),
        ("stg_events", "fct_sessions"),
    )
    table("fct_page_views", lambda: fct_page_views(wide()), bridged)
    table("fct_funnel_steps", lambda: funnel_steps(mart("fct_sessions"), steps), ("fct_sessions",))
    table("agg_daily_traffic", lambda: daily_traffic(mart("fct_sessions")), ("fct_sessions",))
    table(
        "agg_funnel_conversion",
        lambda: funnel_conversion(mart("fct_funnel_steps")),
        ("fct_funnel_steps",),
    )
    return run_id


def test_models(spark: SparkSession, select: list[str] | None = None) -> str:
    """Run the declared checks on the built tables and log them; returns the run id."""
    relations = {
        name.split(".")[1]: spark.table(name)
        for name in schema.RELATIONS
        if spark.catalog.tableExists(name)
    }
    run_id = str(uuid.uuid4())
    warehouse.log_test_results(Suite(relations, CHECKS, select).run(), run_id)
    return run_id
