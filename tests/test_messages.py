"""Decoding and validation: one case per rule, and forms that are accepted."""

import json
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from footfall.functions.timestamps import parse_iso8601
from footfall.sources.lines import read_json_lines, write_json_lines
from footfall.sources.log import publish, publish_counts, publish_projection, publish_writer
from footfall.sources.messages import (
    clean_text,
    dead_letters,
    first_offset,
    from_log,
    max_offset_per_partition,
    valid_events,
    validate_events,
)

ID = "6fa459ea-ee8a-3ca4-894e-db77e160355e"


def doc(**changes):
    base = {
        "event_id": ID,
        "event_name": "page_view",
        "anonymous_id": "anon_1",
        "occurred_at": "2026-07-20T10:15:30+00:00",
    }
    return {k: v for k, v in (base | changes).items() if v is not ...}


def raw(**changes):
    return json.dumps(doc(**changes)).encode()


def purchase(**order):
    return raw(event_name="purchase", order=order)


def log(spark, values):
    rows = [("t", 0, i, b"key", v, None) for i, v in enumerate(values)]
    from footfall.schema import LOG_MESSAGE

    return from_log(spark.createDataFrame(rows, LOG_MESSAGE))


GOOD = json.dumps(doc())
REJECTED = [
    (None, "message value is empty (tombstone?)"),
    (b"\xff\xfe\x00", "message value is not UTF-8"),
    (b"{not json", "message value is not valid JSON"),
    (b"", "message value is not valid JSON"),
    (b"  ", "message value is not valid JSON"),
    (GOOD.encode() + b"}", "message value is not valid JSON"),
    (GOOD.encode() + b"],[", "message value is not valid JSON"),
    (GOOD.encode() + b"," + GOOD.encode(), "message value is not valid JSON"),
    (b"[1,2,3]", "expected a JSON object, got list"),
    (b'"x"', "expected a JSON object, got str"),
    (b" 12", "expected a JSON object, got int"),
    (b"1.5", "expected a JSON object, got float"),
    (b"true", "expected a JSON object, got bool"),
    (b"null", "expected a JSON object, got NoneType"),
    (raw(event_name=...), "missing required field 'event_name'"),
    (raw(event_id=...), "missing required field 'event_id'"),
    (raw(anonymous_id=...), "missing required field 'anonymous_id'"),
    (raw(occurred_at=...), "missing required field 'occurred_at'"),
    (raw(occurred_at=None), "missing required field 'occurred_at'"),
    (raw(anonymous_id=" \t "), "missing required field 'anonymous_id'"),
    (raw(event_name="rage_click", event_id=...), "unknown event_name 'rage_click'"),
    (raw(event_name="it's"), "unknown event_name \"it's\""),
    (raw(event_name=["a"]), "unknown event_name '[\"a\"]'"),
    (raw(event_id="evt-1"), "event_id is not a UUID: 'evt-1'"),
    (raw(event_id="evt-1", anonymous_id=...), "event_id is not a UUID: 'evt-1'"),
    (raw(occurred_at="last tuesday"), "occurred_at is not ISO-8601: 'last tuesday'"),
    (raw(event_name="product_view"), "product_view requires product.product_id"),
    (raw(event_name="add_to_cart", product=[1]), "add_to_cart requires product.product_id"),
    (
        raw(event_name="add_to_cart", product={"product_id": ""}),
        "add_to_cart requires product.product_id",
    ),
    (
        raw(event_name="add_to_cart", product={"product_id": 0}),
        "add_to_cart requires product.product_id",
    ),
    (purchase(revenue_usd=10.0), "purchase requires order.order_id"),
    (
        purchase(order_id="o", revenue_usd=-5),
        "purchase requires a non-negative order.revenue_usd, got -5",
    ),
    (
        purchase(order_id="o", revenue_usd="12"),
        "purchase requires a non-negative order.revenue_usd, got '12'",
    ),
    (purchase(order_id="o"), "purchase requires a non-negative order.revenue_usd, got None"),
]
ACCEPTED = [
    raw(),
    b"  " + raw() + b"\n",
    raw(event_id=ID.upper()),
    raw(event_id="{" + ID.replace("-", "") + "}"),
    raw(event_id="urn:uuid:" + ID),
    raw(occurred_at="2026-07-20T12:15:30+02:00"),
    raw(occurred_at="2026-07-20T10:15:30"),
    raw(occurred_at=" 20260720T101530Z "),
    raw(event_name="product_view", product={"product_id": "0"}),
    raw(event_name="product_view", product={"product_id": 7}),
    purchase(order_id="o", revenue_usd=0),
    purchase(order_id="o", revenue_usd=1e3),
    purchase(order_id="o", revenue_usd=True),
    raw()[:-1] + b',"event_name":"search"}',
]


def test_rejections(spark):
    found = validate_events(log(spark, [v for v, _ in REJECTED])).orderBy("kafka_offset").collect()
    assert [r.error for r in found] == [e for _, e in REJECTED]
    assert all(r.event_id is None and r.payload is None for r in found)


def test_acceptance(spark):
    found = validate_events(log(spark, ACCEPTED)).orderBy("kafka_offset").collect()
    assert [r.error for r in found] == [None] * len(ACCEPTED)
    assert {r.event_id for r in found} == {ID}
    assert {r.occurred_at for r in found} == {datetime(2026, 7, 20, 10, 15, 30)}
    assert found[-1].event_name == "search"  # the last of two equal keys


TIMES = [
    "2026-07-20", "20260720", "2026-07-20T10", "2026-07-20T10:15", "20260720T101530", "20260720T1015",
    "2026-07-20 10:15:30.1", "2026-07-20T10:15:30,123", "2026-07-20T10:15:30.123456789+01:00",
    "2026-07-20T10:15:30-0530", "2026-07-20T10:15:30-05", "2026-07-20x10:15:30", "2026-W30-1",
    "2026W301", "2026-W30", "2026-W30-1T10:15", "2020-W53-7", " 2026-07-20T10:15:30z ",
    "2026-07-20+05:00", "20260720 101530.5+0200", "2026-07-20T10Z",
    # and some that are none
    "12:30", "2026", "2026-07", "2026-13-01", "2026-02-30", "2026-07-20T24:00:00",
    "2026-07-20T10:15:60", "2026-07-20T", "2026-W60-1", "2021-W53-1", "0000-01-01",
    "2026-07-20T10:1530", "2026-07-20T1015:30", "", "2026-7-2", "2026-07-20T10:15:30.",
    "2026-07-20T10:15:30+2:00",
]


def python_time(text):
    text = text.strip()
    text = text[:-1] + "+00:00" if text.endswith(("Z", "z")) else text
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return None
    if parsed.tzinfo is None:
        return parsed
    return parsed.astimezone(timezone.utc).replace(tzinfo=None)


def test_timestamps_as_python_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t STRING")
    rows = df.select("t", parse_iso8601(F.col("t")).cast("timestamp_ntz").alias("at")).collect()
    assert {r.t: r["at"] for r in rows} == {t: python_time(t) for t in TIMES}


@pytest.mark.parametrize(
    "value, limit, expected",
    [
        (b'{"a": 1}', 8000, '{"a": 1}'),
        (None, 8000, None),
        (b"\xff\xfe\x00\x01", 8000, "��\\x00\x01"),
        (b"a\x00b", 8000, "a\\x00b"),
        (b"x" * 20_000, 8000, "x" * 8000),
        (b"x" * 999, 10, "x" * 10),
        ("é".encode() * 20, 10, "é" * 10),
    ],
)
def test_clean_text(spark, value, limit, expected):
    df = spark.createDataFrame([(value,)], "v BINARY")
    assert df.select(clean_text(F.col("v"), limit)).first()[0] == expected


def test_dead_letters_keep_place_and_text(spark):
    judged = validate_events(log(spark, [b"{not json", raw()])).withColumn("batch_id", F.lit(3))
    (row,) = dead_letters(judged).collect()
    assert (row.batch_id, row.kafka_offset, row.message_value) == (3, 0, "{not json")
    assert row.message_key == "key"


def test_first_offset_wins_and_offsets_resume_after_the_last(spark):
    messages = log(spark, [raw(), raw(event_name="search"), raw(event_id=str(uuid.uuid4()))])
    kept = first_offset(valid_events(validate_events(messages)))
    assert kept.count() == 2
    assert kept.where(F.col("event_id") == ID).first().event_name == "page_view"
    (top,) = max_offset_per_partition(messages).collect()
    assert (top.max_offset, top.resume_offset) == (2, 3)


def test_first_offset_moves_no_payload_and_breaks_ties(spark):
    from plans import physical

    rows = [
        ("a", "t", 0, 7, "late"), ("a", "t", 1, 3, "other partition"), ("a", "t", 0, 3, "first"),
        ("b", "t", 0, 9, "alone"), ("c", "t", 2**31 - 1, 2**63 - 1, "far"),
        ("c", "t", 2**31 - 2, 2**63 - 1, "nearer"),
        ("d", "t", 0, 1, "twice"), ("d", "t", 0, 1, "twice"), ("e", "t", 0, 2, "x"), ("e", "u", 0, 2, "y"),
    ]
    df = spark.createDataFrame(
        rows, "event_id STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, payload STRING"
    )
    kept = first_offset(df)
    found = {r.event_id: r.payload for r in kept.collect()}
    assert kept.count() == 5 and found.pop("e") in ("x", "y")
    assert found == {"a": "first", "b": "alone", "c": "nearer", "d": "twice"}
    # texts are sorted for ties alone
    sorts = [line for line in physical(kept) if "SortAggregate" in line]
    assert sorts and all("min_by" in line for line in sorts)
    assert not any("payload" in line for line in physical(kept) if "HashAggregate" in line)


def test_publishing_checks_the_same_rules(spark, tmp_path):
    messages = log(spark, [raw(), b"[]", raw(anonymous_id="other")])
    assert tuple(publish_counts(messages).first()) == (2, 1)
    assert {r.key for r in publish_projection(messages).collect()} == {"anon_1", "other"}
    publish_writer(messages, "parquet").save(str(tmp_path / "sent"))
    counted = publish(messages, "parquet", {"path": str(tmp_path / "counted")})
    assert counted == {"produced": 2, "invalid": 1}
    assert spark.read.parquet(str(tmp_path / "counted")).count() == 2
    assert spark.read.parquet(str(tmp_path / "sent")).columns == ["key", "value"]


def test_json_lines_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    events = spark.createDataFrame([(json.dumps(doc(), indent=1),)], "payload STRING")
    write_json_lines(events, path)
    (written,) = [r.value for r in spark.read.text(path).collect()]
    assert " " not in written and json.loads(written) == doc()
    (tmp_path / "lines" / "more.txt").write_text("\n   \n" + GOOD + "\n\nnot json\n")
    found = validate_events(read_json_lines(spark, path))
    assert found.where(F.col("error").isNull()).count() == 2
    assert found.where(F.col("error").isNotNull()).count() == 1


def test_reason_shows_a_float_as_one(spark):
    texts = ["-8.00", "-75.50", "-8", "-1e3", "-0.0001", "-0.00001", "-12345678.25", "-1.5E+20", "-1e16"]
    texts += ["-9007199254740991.0", "-12345678901234567890", "-123456789.123456789123", "-2.5e-7"]
    sent = purchase(order_id="o", revenue_usd=-5)
    assert sent.count(b"-5") == 1
    values = [sent.replace(b"-5", t.encode()) for t in texts]
    found = validate_events(log(spark, values)).orderBy("kafka_offset").collect()
    shown = [r.error.rsplit(" ", 1)[1] for r in found]
    assert shown == [repr(json.loads(t)) for t in texts]


def test_long_methods_are_left_and_only_texts_with_blank_edges_searched(spark):
    from footfall.functions.timestamps import strip

    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    texts = ["", " ", "a b", " a b\u2003", "\x85a\n", "a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", strip(F.col("t")).alias("s"))
    assert [r.s for r in df.collect()] == ["", "", "a b", "a b", "a", "a", None]
    assert "CASE WHEN" in spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
