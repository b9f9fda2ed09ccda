"""Late events: only touched sessions are cut again, with the result of a full rebuild."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators import late as operators
from footfall.operators.sessions import bridge, sessionize
from footfall.plans import late, warehouse

START = datetime(2024, 3, 1, 12, 0, 0)
COLUMNS = "event_id STRING, anonymous_id STRING, occurred_at TIMESTAMP, page STRING"


def events(spark, rows):
    made = [(i, v, START + timedelta(minutes=m), f"p{i}") for i, v, m in rows]
    return spark.createDataFrame(made, COLUMNS)


def told(df):
    return sorted(map(tuple, bridge(df).collect()), key=repr)


def touched(spark, stored, fresh):
    spans = operators.session_spans(operators.dated(sessionize(events(spark, stored))))
    found = operators.touched_sessions(spans, events(spark, fresh))
    return sorted((r.anonymous_id, (r.started - START).total_seconds() / 60) for r in found.collect())


STORED = [("a", "v", 0), ("b", "v", 20), ("c", "v", 100), ("d", "v", 300), ("e", "w", 0), ("f", None, 50)]


@pytest.mark.parametrize(
    "at, expected",
    [
        (-30, [("v", 0)]),  # a gap of exactly the timeout joins
        (-30.01, []),
        (10, [("v", 0)]),
        (50, [("v", 0)]),
        (50.01, []),
        (75, [("v", 100)]),
        (270, [("v", 300)]),
        (330.01, []),
        (5000, []),
    ],
)
def test_sessions_within_the_timeout_are_touched(spark, at, expected):
    assert touched(spark, STORED, [("x", "v", at)]) == expected


def test_touched_by_several_other_or_no_visitors(spark):
    assert touched(spark, STORED, [("y", "z", 0), ("z", "w", 29)]) == [("w", 0)]
    assert touched(spark, STORED, [("x", None, 60)]) == [(None, 50)]
    assert touched(spark, STORED, []) == []
    # a long session is met in the middle of it, and by the last event of a stretch
    long = [(f"s{k}", "v", 25 * k) for k in range(100)]
    assert touched(spark, long, [("x", "v", 1234.5)]) == [("v", 0)]
    assert touched(spark, [("a", "v", 59)], [("x", "v", 0.5), ("y", "v", 29.5)]) == [("v", 59)]


@pytest.mark.parametrize("seed", [1])
def test_updates_equal_a_full_rebuild(spark, databases, seed):
    lot = random.Random(seed)
    name = f"stg.late_{seed}"
    # one visitor has half of the events, and is cut into slices
    rows = [
        (f"e{k:04d}", "hot" if k % 2 else f"v{lot.randrange(6)}", lot.choice([lot.randrange(6000), 30 * lot.randrange(200)]))
        for k in range(900)
    ]
    lot.shuffle(rows)
    late.store_sessions(events(spark, rows[:500]), name)
    known = 500
    for upto in (502, 600, 900):
        # some of the events come again
        late.add_events(events(spark, rows[known - 20 : upto]), name)
        known = upto
        whole = sessionize(events(spark, rows[:upto]))
        assert told(spark.table(name)) == told(whole)
        assert spark.table(name).where(f"{operators.SESSION_DATE} <> to_date(session_started_at)").count() == 0
    assert late.add_events(events(spark, []), name) == 0
    assert spark.table(name).count() == 900


def test_other_dates_are_left_alone(spark, databases):
    name = "stg.late_dates"
    day = 24 * 60
    rows = [(f"d{d}{k}", "v", d * day + 10 * k) for d in range(4) for k in range(3)]
    late.store_sessions(events(spark, rows), name)

    def files():
        found = spark.table(name).select(operators.SESSION_DATE, F.input_file_name().alias("f")).distinct()
        return {str(r[0]): r.f for r in found.collect()}

    before = files()
    # one event joins the end of the second day
    assert late.add_events(events(spark, [("new", "v", day + 40)]), name) == 4
    after = files()
    assert {d for d in before if before[d] != after[d]} == {"2024-03-02"}
    # an event before midnight takes a session that began after it to the day before
    late.add_events(events(spark, [("m", "u", 12 * 60 + 5)]), name)
    assert late.add_events(events(spark, [("n", "u", 12 * 60 - 5)]), name) == 2
    moved = spark.table(name).where("anonymous_id = 'u'").collect()
    assert {str(r[operators.SESSION_DATE]) for r in moved} == {"2024-03-01"}
    assert sorted(r.event_seq_in_session for r in moved) == [1, 2]


def test_spans_of_the_caller_are_used(spark, databases):
    name = "stg.late_spans"
    late.store_sessions(events(spark, STORED), name)
    spans = operators.session_spans(spark.table(name))
    late.add_events(events(spark, [("x", "v", 60)]), name, spans=spans)
    assert told(spark.table(name)) == told(sessionize(events(spark, [*STORED, ("x", "v", 60)])))
    assert warehouse.one_per_key(spark.table(name), ["event_id"]).count() == len(STORED) + 1
