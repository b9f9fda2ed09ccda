import pytest
from pyspark.sql import functions as F
from test_sessions import events

from footfall import schema
from footfall.operators.funnel import (
    funnel_conversion,
    funnel_steps,
    step_list,
    with_step_times,
)
from footfall.operators.sessions import fct_sessions, sessionize


def reached(spark, rows):
    ses = sessionize(events(spark, rows))
    steps = funnel_steps(fct_sessions(ses, schema.FUNNEL_STEPS)).orderBy("step_index").collect()
    again = funnel_steps(with_step_times(fct_sessions(ses), ses)).orderBy("step_index").collect()
    assert steps == again
    return [(r.step_name, r.is_final_step) for r in steps]


def test_no_page_view_no_funnel(spark):
    assert reached(spark, [("a", "v", 0, "product_view"), ("b", "v", 1, "add_to_cart")]) == []


def test_missing_step_ends_the_funnel(spark):
    rows = [("a", "v", 0, "page_view"), ("b", "v", 1, "add_to_cart"), ("c", "v", 2, "purchase")]
    assert reached(spark, rows) == [("page_view", True)]


def test_step_before_its_predecessor_ends_the_funnel(spark):
    rows = [
        ("a", "v", 0, "page_view"),
        ("b", "v", 5, "product_view"),
        ("c", "v", 3, "add_to_cart"),
        ("d", "v", 9, "add_to_cart"),
    ]
    assert reached(spark, rows) == [("page_view", False), ("product_view", True)]


def test_equal_times_are_in_order(spark):
    rows = [("a", "v", 0, "page_view"), ("b", "v", 0, "product_view")]
    assert reached(spark, rows) == [("page_view", False), ("product_view", True)]


def test_repeated_steps_are_refused(spark):
    ses = sessionize(events(spark, [("a", "v", 0, "page_view")]))
    with pytest.raises(ValueError):
        funnel_steps(fct_sessions(ses, ["page_view"]), ["page_view", "page_view"])


def test_step_list(spark):
    rows = spark.range(1).select(step_list("a,b,c")).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, "b"), (3, "c")]


def test_conversion_rates(spark):
    rows = []
    for i in range(3):
        rows.append((f"p{i}", f"v{i}", 0, "page_view"))
    rows += [("q0", "v0", 10, "product_view"), ("q1", "v1", 21, "product_view")]
    ses = sessionize(events(spark, rows))
    found = (
        funnel_conversion(funnel_steps(fct_sessions(ses, schema.FUNNEL_STEPS)))
        .where(F.col("channel") == schema.ALL_CHANNELS)
        .orderBy("step_index")
        .collect()
    )
    first, second = found
    assert (first.sessions_reached, first.sessions_stopped_here, first.sessions_lost) == (3, 1, 0)
    assert first.step_conversion_pct is None and float(first.overall_conversion_pct) == 100
    assert (float(second.step_conversion_pct), float(second.step_dropoff_pct)) == (66.67, 33.33)
    assert (second.sessions_lost, float(second.avg_seconds_to_reach)) == (1, 15.5)
