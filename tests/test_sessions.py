"""Session boundaries, sequences, and very active visitors."""

from datetime import datetime, timedelta

import pytest
from compare import rows_of
from plans import main_path
from pyspark.sql import functions as F

from footfall import schema
from footfall.fixtures import adapter
from footfall.operators.funnel import funnel_steps
from footfall.operators.pageviews import fct_page_views
from footfall.operators.sessions import bridge, fct_sessions, sessionize
from footfall.operators.slices import SLICE
from footfall.session import stage

START = datetime(2024, 1, 1, 10, 0, 0)
COLUMNS = (
    "event_id STRING, anonymous_id STRING, occurred_at TIMESTAMP, event_name STRING, "
    "page_path STRING, product_id STRING, order_id STRING, order_revenue_usd DECIMAL(12,2), "
    "user_id STRING, referrer STRING, utm_source STRING, utm_medium STRING"
)
OTHERS = ["page_title", "page_type", "device_type", "browser", "os", "country", "utm_campaign"]


def events(spark, rows):
    """rows: (event_id, visitor, seconds after START, name, further columns)."""
    data = []
    for event_id, visitor, after, name, *more in rows:
        extra = more[0] if more else {}
        data.append(
            {
                "event_id": event_id,
                "anonymous_id": visitor,
                "occurred_at": START + timedelta(seconds=after),
                "event_name": name,
            }
            | extra
        )
    names = schema.names(COLUMNS)
    df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in data], COLUMNS)
    return df.withColumns({c: F.lit(None).cast("string") for c in OTHERS})


def by_id(df, key="event_id"):
    return {row[key]: row for row in df.collect()}


def test_gap_of_exactly_the_timeout_continues_the_session(spark):
    found = by_id(
        sessionize(
            events(
                spark,
                [
                    ("a", "v", 0, "search"),
                    ("b", "v", 1800, "search"),
                    ("c", "v", 3600.000001, "search"),
                ],
            )
        )
    )
    assert found["a"].session_id == found["b"].session_id
    assert found["c"].session_id != found["b"].session_id
    assert [found[i].event_seq_in_session for i in "abc"] == [1, 2, 1]


def test_events_of_one_time_are_ordered_by_id(spark):
    found = by_id(sessionize(events(spark, [("b", "v", 5, "search"), ("a", "v", 5, "search")])))
    assert (found["a"].event_seq_in_session, found["b"].event_seq_in_session) == (1, 2)


def test_timeout_must_be_positive(spark):
    with pytest.raises(ValueError):
        sessionize(events(spark, [("a", "v", 0, "search")]), timeout_minutes=0)


def plain_sessions(rows, minutes):
    """The same rule as a loop over sorted events."""
    expected, last = {}, {}
    for row in sorted(rows, key=lambda r: (r.anonymous_id, r.occurred_at, r.event_id)):
        before = last.get(row.anonymous_id)
        new = before is None or row.occurred_at - before[0] > timedelta(minutes=minutes)
        start, seq = (row.occurred_at, 1) if new else (before[1], before[2] + 1)
        last[row.anonymous_id] = (row.occurred_at, start, seq)
        expected[row.event_id] = (start, seq)
    return expected


def skewed(spark, sf_dir):
    """Staged events of which every third belongs to one visitor, with equal times."""
    busy = F.xxhash64("event_id") % 3 == 0
    return (
        adapter.staged(spark, sf_dir)
        .withColumn("anonymous_id", F.when(busy, "crawler").otherwise(F.col("anonymous_id")))
        .withColumn("occurred_at", F.date_trunc("minute", "occurred_at"))
    )


@pytest.mark.parametrize(
    "minutes, parts", [(5, 60), (30, 8), (240, 200), (1440, 60), (20000, 200), (20000, 3)]
)
def test_slices_do_not_change_sessions(spark, sf_dir, minutes, parts):
    stg = skewed(spark, sf_dir).select("event_id", "anonymous_id", "occurred_at")
    sliced = sessionize(stg, minutes, parts=parts)
    found = {r.event_id: (r.session_started_at, r.event_seq_in_session) for r in sliced.collect()}
    assert found == plain_sessions(stg.collect(), minutes)
    assert sliced.where(F.col("anonymous_id") == "crawler").select(SLICE).distinct().count() > 1


def test_events_of_one_time_are_sliced_by_id(spark, sf_dir):
    stg = (
        skewed(spark, sf_dir)
        .where(F.col("anonymous_id") == "crawler")
        .withColumn("occurred_at", F.lit(START))
        .select("event_id", "anonymous_id", "occurred_at")
    )
    sliced = sessionize(stg, 30, parts=100)
    found = {r.event_id: (r.session_started_at, r.event_seq_in_session) for r in sliced.collect()}
    assert found == plain_sessions(stg.collect(), 30)
    assert sliced.select(SLICE).distinct().count() > 50


def test_slices_stay_even_with_a_stray_time_and_a_burst(spark):
    at = F.when(F.col("id") == 0, F.lit("1970-01-01").cast("timestamp")).otherwise(
        F.lit(START).cast("timestamp")
        + F.make_dt_interval(secs=F.when(F.col("id") < 15_000, F.col("id") % 3600).otherwise(
            F.col("id") * 60
        ))
    )
    one = spark.range(20_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("crawler").alias("anonymous_id"),
        at.alias("occurred_at"),
    )
    sizes = [r["count"] for r in sessionize(one, 30, parts=20).groupBy(SLICE).count().collect()]
    assert sum(sizes) == 20_000
    assert max(sizes) <= 3_000


def same(one, other):
    return rows_of(one.columns, one.collect()) == rows_of(other.columns, other.collect())


@pytest.mark.parametrize("minutes", [60, 20000])
def test_slices_do_not_change_facts(spark, sf_dir, minutes):
    stg = skewed(spark, sf_dir).persist()
    whole = sessionize(stg, minutes).persist()
    sliced = sessionize(stg, minutes, parts=100).persist()
    assert same(bridge(whole), bridge(sliced))
    assert same(fct_page_views(whole), fct_page_views(sliced))
    steps = schema.FUNNEL_STEPS
    assert same(fct_sessions(whole, steps), fct_sessions(sliced, steps))
    assert same(
        funnel_steps(fct_sessions(whole, steps)), funnel_steps(fct_sessions(sliced, steps))
    )


def test_longer_timeout_never_adds_sessions(spark, sf_dir):
    stg = adapter.staged(spark, sf_dir)
    counts = [
        sessionize(stg, minutes).select("session_id").distinct().count()
        for minutes in (5, 30, 120, 1440)
    ]
    assert counts == sorted(counts, reverse=True)


def test_single_event_session(spark):
    ses = sessionize(events(spark, [("a", "v", 0, "page_view", {"page_path": "/"})]))
    row = fct_sessions(ses).first()
    assert (row.duration_seconds, row.is_bounce, row.channel) == (0, True, "direct")
    view = fct_page_views(ses).first()
    assert view.is_entry_page and view.is_exit_page and view.seconds_on_page is None


def test_page_view_without_path_counts_in_the_session_only(spark):
    ses = sessionize(
        events(
            spark,
            [
                ("a", "v", 0, "page_view"),
                ("b", "v", 10, "page_view", {"page_path": "/x", "referrer": "r"}),
            ],
        )
    )
    row = fct_sessions(ses).first()
    assert (row.page_views, row.unique_pages) == (2, 1)
    assert (row.entry_page_path, row.exit_page_path, row.landing_referrer) == (None, "/x", "r")
    assert fct_page_views(ses).count() == 1


def test_seconds_are_rounded_not_cut(spark):
    ses = sessionize(
        events(
            spark,
            [
                ("a", "v", 0, "page_view", {"page_path": "/"}),
                ("b", "v", 2.5, "page_view", {"page_path": "/x"}),
            ],
        )
    )
    assert fct_sessions(ses).first().duration_seconds == 3
    assert by_id(fct_page_views(ses), "page_view_id")["a"].seconds_on_page == 3


def test_search_does_not_prevent_a_bounce(spark):
    ses = sessionize(
        events(spark, [("a", "v", 0, "page_view", {"page_path": "/"}), ("b", "v", 1, "search")])
    )
    assert fct_sessions(ses).first().is_bounce


def test_unknown_medium_or_source_alone_is_other(spark):
    ses = sessionize(
        events(
            spark,
            [
                ("a", "v", 0, "search", {"utm_medium": "affiliate"}),
                ("b", "w", 0, "search", {"utm_source": "s"}),
            ],
        )
    )
    assert {r.channel for r in fct_sessions(ses).collect()} == {"other"}


def operators(df, name):
    return [o for o in main_path(df) if o.startswith(name)]


def test_events_are_shuffled_and_sorted_once(spark, sf_dir):
    ses = sessionize(adapter.staged(spark, sf_dir), 1440)
    for df in (ses, fct_page_views(ses)):
        assert len(operators(df, "Exchange")) == 1
        assert len(operators(df, "Sort ")) == 1
    # one row per session goes on to the second shuffle, beside the one that dealt the events
    assert len(operators(fct_sessions(ses), "Exchange")) == 2


def test_funnel_adds_no_shuffle(spark, sf_dir):
    sessions = fct_sessions(sessionize(adapter.staged(spark, sf_dir), 1440), schema.FUNNEL_STEPS)
    assert len(operators(funnel_steps(sessions), "Exchange")) == 2


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    stg = stage(adapter.staged(spark, sf_dir), "stg")
    scan = main_path(bridge(sessionize(stg, 1440)))[-1]
    assert "FileScan parquet [event_id" in scan and "page_path" not in scan
