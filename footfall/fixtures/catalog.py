"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schema
from footfall.fixtures import adapter
from footfall.functions.channels import channel
from footfall.functions.keys import uuid_key
from footfall.operators import dims, funnel, quality, reports, sessions, staging, traffic
from footfall.operators.pageviews import fct_page_views
from footfall.plans import late, models, warehouse
from footfall.plans.checks import CHECKS
from footfall.plans.models import marts
from footfall.session import configure, scratch_path, stage
from footfall.sources import lines, log, messages

Query = Callable[[SparkSession, str], DataFrame]

# The test events are hours apart, so sessions end after a day without events.
DAY = 24 * 60
EVENT = ["event_id", "event_name", "anonymous_id", "occurred_at"]


def plain(df: DataFrame) -> DataFrame:
    """Only column types that every engine compares alike."""

    def simple(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.MapType):
            column = F.to_json(column)
        return column.alias(field.name)

    return df.select(*[simple(field) for field in df.schema.fields])


# --- relations derived from the test tables -----------------------------------


def _stg(spark: SparkSession, d: str) -> DataFrame:
    return adapter.staged(spark, d)


def _ses(spark: SparkSession, d: str, minutes: int = DAY) -> DataFrame:
    return sessions.sessionize(_stg(spark, d), minutes)


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return sessions.fct_sessions(_ses(spark, d))


def _funnel(spark: SparkSession, d: str) -> DataFrame:
    return funnel.funnel_steps(sessions.fct_sessions(_ses(spark, d), schema.FUNNEL_STEPS))


def _conversion(spark: SparkSession, d: str) -> DataFrame:
    return funnel.funnel_conversion(_funnel(spark, d))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return traffic.daily_traffic(_sessions(spark, d))


def _marts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All relations, each that feeds others stored once in the scratch folder."""
    return marts(stage(_stg(spark, d), "stg_events"), DAY, keep=stage)


#: Messages stored ahead, by folder of the test tables; the benchmark fills it.
SENT: dict[str, DataFrame] = {}


def _sent(spark: SparkSession, d: str) -> DataFrame:
    return SENT[d] if d in SENT else adapter.messages(spark, d, redelivered=True)


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Validated messages; those redelivered come in the batch after."""
    sent = _sent(spark, d)
    again = F.col("kafka_offset") >= adapter.REDELIVERY_OFFSET
    late = sent.withColumn("batch_id", F.col("batch_id") + again.cast("bigint"))
    return messages.validate_events(late)


def _databases(spark: SparkSession) -> None:
    """Databases for stored tables, in the scratch folder where they are not there already."""
    warehouse.create_databases(spark, scratch_path(spark, "warehouse"))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Validated messages without their texts, stored because they are read several times."""
    return stage(_judged(spark, d).drop("message_key", "message_value", "payload"), "validated")


def _first(validated: DataFrame) -> DataFrame:
    return messages.first_offset(validated.where(F.col("error").isNull()).drop("error", "kafka_topic"))


def _winners(spark: SparkSession, d: str) -> DataFrame:
    return _first(_stored(spark, d))


# --- ingest -------------------------------------------------------------------


def validate_events(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("kafka_partition", "kafka_offset", "error", *EVENT)


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    return messages.dead_letters(_judged(spark, d)).drop("dead_letter_id", "kafka_topic")


def clean_reject_text(spark: SparkSession, d: str) -> DataFrame:
    raw = F.col("text").cast("binary")
    return spark.read.parquet(f"{d}/documents.parquet").select(
        "doc_id",
        messages.clean_text(raw).alias("message_value"),
        messages.clean_text(raw, schema.REJECT_KEY_CHARS).alias("message_key"),
        messages.clean_text(raw, schema.REJECT_VALUE_CHARS).alias("limited_value"),
    )


def dedup_first_offset(spark: SparkSession, d: str) -> DataFrame:
    return _winners(spark, d)


def land_anti_join(spark: SparkSession, d: str) -> DataFrame:
    landed = _stg(spark, d).where(F.col("occurred_at") < "2024-01-16")
    new = messages.unseen(_winners(spark, d), landed)
    return new.select(*EVENT, "kafka_partition", "kafka_offset")


def _batches(spark: SparkSession, d: str) -> DataFrame:
    validated = _stored(spark, d)
    return messages.ingest_batch_stats(validated, _first(validated))


def ingest_batch_stats(spark: SparkSession, d: str) -> DataFrame:
    return _batches(spark, d).drop("topic")


def max_offset_per_partition(spark: SparkSession, d: str) -> DataFrame:
    sent = adapter.messages(spark, d, redelivered=True)
    return messages.max_offset_per_partition(sent).drop("kafka_topic")


def publish_projection(spark: SparkSession, d: str) -> DataFrame:
    return log.publish_projection(adapter.messages(spark, d))


def publish_counts(spark: SparkSession, d: str) -> DataFrame:
    return log.publish_counts(adapter.messages(spark, d))


def json_lines_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines.write_json_lines(adapter.raw_events(spark, d), path)
    return messages.validate_events(lines.read_json_lines(spark, path)).select(*EVENT)


# --- staging ------------------------------------------------------------------


def stg_events_flatten(spark: SparkSession, d: str) -> DataFrame:
    return staging.flatten_events(adapter.raw_events(spark, d))


def _stale(spark: SparkSession, d: str) -> DataFrame:
    """A staging table that was last brought up to date on 20 January."""
    old = _stg(spark, d).where(F.col("ingested_at") < "2024-01-21")
    return old.withColumn("page_title", F.lit("stale"))


def incremental_overlap_slice(spark: SparkSession, d: str) -> DataFrame:
    slice_ = staging.incremental_slice(adapter.raw_events(spark, d), _stale(spark, d))
    return slice_.select(*EVENT, "ingested_at")


def incremental_upsert(spark: SparkSession, d: str) -> DataFrame:
    target = _stale(spark, d)
    fresh = staging.flatten_events(staging.incremental_slice(adapter.raw_events(spark, d), target))
    merged = warehouse.merged(target, fresh, ["event_id"])
    return merged.select(*EVENT, "page_title", "ingested_at")


def stored_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert into a stored table, of which only touched partitions are rewritten."""
    _databases(spark)
    name = f"stg.upserted_{uuid.uuid4().hex}"
    day = F.to_date("ingested_at")
    old = _stale(spark, d)
    warehouse.upsert(old.withColumn("day", day), name, ["event_id"], partition="day")
    slice_ = staging.incremental_slice(adapter.raw_events(spark, d), old)
    fresh = staging.flatten_events(slice_).select(*old.columns)
    warehouse.upsert(fresh.withColumn("day", day), name, ["event_id"], partition="day")
    return spark.table(name).select(*EVENT, "page_title", "ingested_at")


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    return _stg(spark, d).select(
        "event_id",
        uuid_key("anonymous_id").alias("visitor_key"),
        uuid_key("page_path").alias("page_key"),
        uuid_key("product_id").alias("product_key"),
    )


def channel_grouping(spark: SparkSession, d: str) -> DataFrame:
    label = channel(F.col("utm_medium"), F.col("utm_source"))
    return _stg(spark, d).select("event_id", label.alias("channel"))


def event_name_counts(spark: SparkSession, d: str) -> DataFrame:
    return staging.event_name_counts(_stg(spark, d))


# --- sessions and facts ---------------------------------------------------------


def sessionize_gap(spark: SparkSession, d: str) -> DataFrame:
    return sessions.bridge(_ses(spark, d))


def sessionize_gap_30_minutes(spark: SparkSession, d: str) -> DataFrame:
    return sessions.bridge(_ses(spark, d, schema.SESSION_TIMEOUT_MINUTES))


def late_events_recut(spark: SparkSession, d: str) -> DataFrame:
    """Stored sessions to which the events of one country come late; only touched ones are cut again."""
    _databases(spark)
    name = f"stg.late_{uuid.uuid4().hex}"
    events = _stg(spark, d)
    behind = F.coalesce(F.col("country") == "JP", F.lit(False))
    late.store_sessions(events.where(~behind), name, DAY)
    late.add_events(events.where(behind), name, DAY)
    return sessions.bridge(spark.table(name))


def bridge_join(spark: SparkSession, d: str) -> DataFrame:
    joined = sessions.bridge_join(_stg(spark, d), sessions.bridge(_ses(spark, d)))
    return joined.select(
        *EVENT, "session_id", "session_started_at", "event_seq_in_session", "page_path"
    )


def page_views(spark: SparkSession, d: str) -> DataFrame:
    return fct_page_views(_ses(spark, d))


def dim_visitor(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_visitor(_stg(spark, d))


def dim_visitor_from_sessions(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_visitor_from_sessions(_sessions(spark, d), _stg(spark, d))


def dim_page(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_page(_stg(spark, d))


def dim_product(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_product(_stg(spark, d))


# --- funnel ---------------------------------------------------------------------


def funnel_step_list(spark: SparkSession, d: str) -> DataFrame:
    """The step list beside the number of events of each step."""
    counts = _stg(spark, d).groupBy("event_name").agg(F.count("*").alias("events"))
    steps = spark.range(1).select(funnel.step_list(",".join(schema.FUNNEL_STEPS)))
    joined = steps.join(counts, F.col("step_name") == F.col("event_name"), "left")
    return joined.select(
        "step_index", "step_name", F.coalesce("events", F.lit(0)).alias("events")
    )


def funnel_semi_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = funnel.filter_steps(_stg(spark, d), schema.FUNNEL_STEPS)
    return kept.select("event_id", "event_name")


def funnel_first_hit(spark: SparkSession, d: str) -> DataFrame:
    return funnel.first_hit(_ses(spark, d))


def funnel_steps_from_stored(spark: SparkSession, d: str) -> DataFrame:
    """The funnel where sessions were stored without step times."""
    sessionized = stage(_ses(spark, d), "sessionized_events")
    stored = sessions.fct_sessions(sessionized)
    return funnel.funnel_steps(funnel.with_step_times(stored, sessionized))


def funnel_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return funnel.funnel_reach(_funnel(spark, d))


# --- reports ----------------------------------------------------------------------


def report_funnel(spark: SparkSession, d: str) -> DataFrame:
    return reports.funnel(_conversion(spark, d))


def report_funnel_channels(spark: SparkSession, d: str) -> DataFrame:
    return reports.funnel_channels(_conversion(spark, d))


def report_traffic(spark: SparkSession, d: str) -> DataFrame:
    return reports.traffic(_daily(spark, d))


def report_channels(spark: SparkSession, d: str) -> DataFrame:
    return reports.channels(_daily(spark, d))


def top_pages(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_pages(page_views(spark, d), dim_page(spark, d))


def top_products(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_products(dim_product(spark, d))


def recent_batches(spark: SparkSession, d: str) -> DataFrame:
    days = F.make_dt_interval(days=F.col("batch_id").cast("int"))
    logged = _batches(spark, d).withColumns(
        {
            "status": F.lit("committed"),
            "started_at": F.lit("2024-01-01").cast("timestamp") + days,
            "error": F.lit(None).cast("string"),
        }
    )
    return reports.recent_batches(logged)


def ingest_overview(spark: SparkSession, d: str) -> DataFrame:
    rejected = messages.dead_letters(_judged(spark, d))
    return reports.ingest_overview(adapter.raw_events(spark, d), rejected)


def _counts(spark: SparkSession, d: str) -> DataFrame:
    built = _marts(spark, d)
    return reports.count_relations({name: built[name.split(".")[1]] for name in schema.RELATIONS})


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    built = _marts(spark, d)
    named: dict[str, DataFrame | None] = {n: built[n.split(".")[1]] for n in schema.RELATIONS}
    return reports.count_relations(named | {"mart.not_built": None})


#: Runs logged for the test tables, by application and folder: a failed build and a build; a test.
_BUILDS: dict[tuple[str, str], tuple[str, str]] = {}
_TESTS: dict[tuple[str, str], tuple[str, str]] = {}


def _has_run(spark: SparkSession, log: str, run_id: str) -> bool:
    return spark.catalog.tableExists(log) and not spark.table(log).where(F.col("run_id") == run_id).isEmpty()


def _built(spark: SparkSession, d: str) -> tuple[str, str]:
    """Build all models from the test tables and return the ids of the logged runs.

    The first build reads payloads with a price that is no number, so it fails; the second is whole.
    """
    key = (spark.sparkContext.applicationId, d)
    known = _BUILDS.get(key)
    if known and _has_run(spark, "meta.model_runs", known[1]):
        return known
    _databases(spark)
    raw = stage(adapter.raw_events(spark, d), "raw_events")
    bad = raw.withColumn("payload", F.lit('{"product": {"price_usd": "cheap"}}'))
    failed = models.build_models(spark, DAY, full_refresh=True, raw=bad)
    built = models.build_models(spark, DAY, full_refresh=True, raw=raw)
    _BUILDS[key] = (failed, built)
    return _BUILDS[key]


def _tested(spark: SparkSession, d: str) -> str:
    """Test the built models and return the id of the logged run.

    Where other tables were built since, these are built again first.
    """
    key = (spark.sparkContext.applicationId, d)
    _, built = _built(spark, d)
    known = _TESTS.get(key)
    if known and known[0] == built and _has_run(spark, "meta.test_results", known[1]):
        return known[1]
    newest = spark.table("meta.model_runs").agg(F.max_by("run_id", "started_at")).first()[0]
    if newest != built:
        del _BUILDS[key]
        _, built = _built(spark, d)
    _TESTS[key] = (built, models.test_models(spark))
    return _TESTS[key][1]


def last_transform_run(spark: SparkSession, d: str) -> DataFrame:
    """The tallies of the later of two builds, from the log they wrote."""
    runs = _built(spark, d)
    log = spark.table("meta.model_runs").where(F.col("run_id").isin(*runs))
    return reports.last_transform_run(log).drop("run_id", "started_at", "finished_at")


def failed_transform_run(spark: SparkSession, d: str) -> DataFrame:
    """The models of the build that failed, with what became of each."""
    failed, _ = _built(spark, d)
    log = spark.table("meta.model_runs").where(F.col("run_id") == failed)
    return log.select("model_name", "status", "rows_affected")


def _results(spark: SparkSession, d: str) -> DataFrame:
    return quality.Suite(_marts(spark, d), CHECKS).results()


def last_test_run(spark: SparkSession, d: str) -> DataFrame:
    run = _tested(spark, d)
    log = spark.table("meta.test_results").where(F.col("run_id") == run)
    return reports.last_test_run(log).drop("run_id", "executed_at")


def failing_tests(spark: SparkSession, d: str) -> DataFrame:
    run = _tested(spark, d)
    return reports.failing_tests(spark.table("meta.test_results"), run)


# --- quality ------------------------------------------------------------------------


def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_null(_stg(spark, d), "page_path")


def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique(_stg(spark, d), "product_id")


def dq_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.accepted_values(_stg(spark, d), "utm_medium", ["organic", "email"])


def dq_relationships(spark: SparkSession, d: str) -> DataFrame:
    stg = _stg(spark, d)
    carted = stg.where(F.col("event_name") == "add_to_cart")
    return quality.relationships(stg, "product_name", carted, "product_name")


def dq_unique_combination(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique_combination(_stg(spark, d), ["anonymous_id", "utm_source"])


def dq_assert_expression(spark: SparkSession, d: str) -> DataFrame:
    return quality.assert_expression(_stg(spark, d), "product_price_usd > 20")


QUERIES: dict[str, Query] = {
    "validate_events": validate_events,
    "dead_letters": dead_letters,
    "clean_reject_text": clean_reject_text,
    "dedup_first_offset": dedup_first_offset,
    "land_anti_join": land_anti_join,
    "ingest_batch_stats": ingest_batch_stats,
    "max_offset_per_partition": max_offset_per_partition,
    "publish_projection": publish_projection,
    "publish_counts": publish_counts,
    "json_lines_ingest": json_lines_ingest,
    "stg_events_flatten": stg_events_flatten,
    "incremental_overlap_slice": incremental_overlap_slice,
    "incremental_upsert": incremental_upsert,
    "stored_upsert": stored_upsert,
    "surrogate_keys": surrogate_keys,
    "channel_grouping": channel_grouping,
    "event_name_counts": event_name_counts,
    "sessionize_gap": sessionize_gap,
    "sessionize_gap_30_minutes": sessionize_gap_30_minutes,
    "late_events_recut": late_events_recut,
    "bridge_join": bridge_join,
    "fct_sessions": _sessions,
    "fct_page_views": page_views,
    "daily_traffic": _daily,
    "dim_visitor": dim_visitor,
    "dim_visitor_from_sessions": dim_visitor_from_sessions,
    "dim_page": dim_page,
    "dim_product": dim_product,
    "funnel_step_list": funnel_step_list,
    "funnel_semi_filter": funnel_semi_filter,
    "funnel_first_hit": funnel_first_hit,
    "funnel_steps": _funnel,
    "funnel_steps_from_stored": funnel_steps_from_stored,
    "funnel_grouping_sets": funnel_grouping_sets,
    "funnel_conversion": _conversion,
    "report_funnel": report_funnel,
    "report_funnel_channels": report_funnel_channels,
    "report_traffic": report_traffic,
    "report_channels": report_channels,
    "top_pages": top_pages,
    "top_products": top_products,
    "recent_batches": recent_batches,
    "ingest_overview": ingest_overview,
    "table_counts": table_counts,
    "last_transform_run": last_transform_run,
    "failed_transform_run": failed_transform_run,
    "last_test_run": last_test_run,
    "failing_tests": failing_tests,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_unique_combination": dq_unique_combination,
    "dq_assert_expression": dq_assert_expression,
    "dq_suite": _results,
}


def _comparable(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(configure(spark), sf_dir))

    run.__name__ = run.__qualname__ = query.__name__.lstrip("_")
    return run


def queries() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in QUERIES.items()}
