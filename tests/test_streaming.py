"""Streaming ingest: bounded runs, replays and repeated batches."""

import json
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_messages import doc

from footfall import schema
from footfall.operators.reports import recent_batches
from footfall.plans import models
from footfall.sources.log import read_event_batch, read_event_stream
from footfall.streaming import ingest
from footfall.streaming.ingest import RawStore, batch_number, first_copies, start_ingest


def write_log(spark, folder, rows):
    """rows: (partition, offset, value)"""
    data = [("t", p, o, b"k", v, None) for p, o, v in rows]
    spark.createDataFrame(data, schema.LOG_MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def event(n, **changes):
    return json.dumps(doc(event_id=str(uuid.UUID(int=n)), **changes)).encode()


def run(spark, source, store, checkpoint, group="g"):
    stream = read_event_stream(spark, "parquet", {"path": source, "maxFilesPerTrigger": "1"})
    query = start_ingest(stream, store, checkpoint, group)
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_replay_and_rerun(spark, tmp_path):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"))
    write_log(spark, source, [(0, 0, event(1)), (0, 1, event(1)), (1, 5, b"{bad"), (1, 7, event(2))])
    run(spark, source, store, str(tmp_path / "c1"))
    write_log(spark, source, [(0, 2, event(2)), (0, 3, event(3))])
    run(spark, source, store, str(tmp_path / "c1"))

    assert store.events().count() == 3
    assert store.dead_letters().first().message_value == "{bad"
    logged = store.batches().orderBy("started_at").collect()
    numbers = [
        (b.messages_read, b.rows_inserted, b.rows_duplicate, b.rows_rejected, b.offsets)
        for b in logged
    ]
    assert numbers == [(4, 2, 1, 1, {0: 1, 1: 7}), (2, 1, 1, 0, {0: 3})]
    assert {b.status for b in logged} == {"committed"}

    # the same checkpoint again reads nothing
    run(spark, source, store, str(tmp_path / "c1"))
    assert store.batches().count() == 2

    # another consumer group reads it all again and inserts nothing
    run(spark, source, store, str(tmp_path / "c2"), "other")
    again = store.batches().where(F.col("consumer_group") == "other").collect()
    assert sum(b.messages_read for b in again) == 6
    assert sum(b.rows_inserted for b in again) == 0
    assert store.events().count() == 3 and store.dead_letters().count() == 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"))
    write_log(spark, source, [(0, 0, event(1)), (0, 1, b"[]"), (0, 2, event(2))])
    batch, number = read_event_batch(spark, "parquet", {"path": source}), batch_number("g", 0)
    store.land(batch, number, "g")
    # as after a crash before the batch row was written
    before = store.batches().first()
    fresh = RawStore(spark, str(tmp_path / "raw"))
    fresh.land(batch, number, "g")
    assert (store.events().count(), store.dead_letters().count(), store.batches().count()) == (2, 1, 1)
    assert (before.rows_inserted, before.rows_rejected) == (2, 1)


def land(store, spark, folder, stream, number=0):
    store.land(read_event_batch(spark, "parquet", {"path": folder}), number, "g", stream)


def test_a_batch_reads_only_its_buckets_and_its_own_folder(spark, tmp_path, monkeypatch):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"), buckets=16)
    write_log(spark, source, [(0, n, event(n)) for n in range(40)] + [(1, 7, b"[]")])
    land(store, spark, source, "one")
    assert store.ids().count() == 40
    assert store.ids().select("bucket").distinct().count() > 8
    later = str(tmp_path / "later")
    write_log(spark, later, [(0, 50, event(3)), (0, 51, event(90)), (1, 9, b"{"), (1, 2_000_000, b"")])
    read, plain = [], RawStore._read

    def watched(self, name, columns, places=None):
        read.append((name, places))
        return plain(self, name, columns, places)

    monkeypatch.setattr(RawStore, "_read", watched)
    land(store, spark, later, "two")
    assert {name for name, _ in read} == {"batches", "ids", "events", "dead_letters"}
    assert all(places is not None for _, places in read)
    (buckets,) = [places for name, places in read if name == "ids"]
    assert len(buckets) <= 2
    (folders,) = [places for name, places in read if name == "dead_letters"]
    assert folders == ["place=1-0", "place=1-2"]
    assert all("batch=" in p for name, places in read if name == "events" for p in places)
    monkeypatch.undo()
    row = store.batches().where("stream_id = 'two'").first()
    assert (row.messages_read, row.rows_inserted, row.rows_duplicate, row.rows_rejected) == (4, 1, 1, 2)


@pytest.mark.parametrize("table", ["ids", "dead_letters", "batches"])
def test_a_batch_that_failed_half_way_runs_again(spark, tmp_path, monkeypatch, table):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"))
    write_log(spark, source, [(0, 0, event(1)), (0, 1, b"[]"), (0, 2, event(2))])
    write, log = ingest._Batch._write, ingest._Batch._log

    def failing(self, rows, name, partitions):
        if name == table:
            raise RuntimeError("lost")
        write(self, rows, name, partitions)

    def failing_log(self, rows, state, at):
        if table == "batches" and state == "committed":
            raise RuntimeError("lost")
        log(self, rows, state, at)

    monkeypatch.setattr(ingest._Batch, "_write", failing)
    monkeypatch.setattr(ingest._Batch, "_log", failing_log)
    with pytest.raises(RuntimeError):
        land(store, spark, source, "one")
    assert [r.status for r in store.batches().collect()] == ["running"]
    monkeypatch.undo()
    # it began before midnight and runs again after
    monkeypatch.setattr(ingest, "now", lambda: datetime.now(timezone.utc) + timedelta(days=1))
    land(store, spark, source, "one")
    assert (store.events().count(), store.ids().count(), store.dead_letters().count()) == (2, 2, 1)
    (row,) = store.batches().collect()
    assert (row.status, row.rows_inserted, row.rows_rejected) == ("committed", 2, 1)


def test_streams_with_equal_numbers_are_kept_apart(spark, tmp_path):
    store = RawStore(spark, str(tmp_path / "raw"))
    for n, stream in enumerate(("one", "two")):
        source = str(tmp_path / stream)
        write_log(spark, source, [(0, n, event(n)), (0, 10 + n, b"[]")])
        land(store, spark, source, stream, number=5)
    assert sorted(r.stream_id for r in store.batches().collect()) == ["one", "two"]
    assert (store.events().count(), store.dead_letters().count()) == (2, 2)


def test_copies_landed_at_the_same_moment_are_told_from_the_ids(spark, tmp_path, monkeypatch):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"))
    write_log(spark, source, [(0, n, event(n)) for n in range(5)])
    # neither sees what the other lands
    plain = RawStore._read
    hidden = lambda self, name, columns, places=None: plain(
        self, name, columns, [] if name == "ids" else places
    )
    monkeypatch.setattr(RawStore, "_read", hidden)
    land(store, spark, source, "one")
    land(store, spark, source, "two")
    monkeypatch.undo()
    assert store.events().count() == 10
    first, later = first_copies(store.events(), store.ids())
    assert {r.stream_id for r in first.collect()} == {"one"} and first.count() == 5
    assert {r.stream_id for r in later.collect()} == {"two"} and later.count() == 5
    write_log(spark, source, [(0, 9, event(9))])
    land(store, spark, source, "three")
    assert store.events().count() == 11


def test_streams_that_land_the_same_messages_at_once_are_staged_once(
    spark, databases, tmp_path, monkeypatch
):
    store = RawStore(spark, str(tmp_path / "raw"))
    plain = RawStore._read
    hidden = lambda self, name, columns, places=None: plain(
        self, name, columns, [] if name == "ids" else places
    )

    def landed(stream, numbers, later, number=0):
        source = str(tmp_path / f"{stream}{number}")
        write_log(spark, source, [(0, n, event(n)) for n in numbers])
        monkeypatch.setattr(ingest, "now", lambda: datetime(2024, 3, 1, 23, 59, later))
        land(store, spark, source, stream, number)

    def staged():
        models.build_models(spark, raw=store.events(), ids=store.ids())
        rows = spark.table(models.STAGED).collect()
        assert len({r.event_id for r in rows}) == len(rows)
        return {int(r.event_id.replace("-", ""), 16): r.ingested_at.day for r in rows}

    monkeypatch.setattr(RawStore, "_read", hidden)
    landed("one", range(5), 50)
    landed("two", range(3, 8), 55)
    monkeypatch.setattr(ingest, "now", lambda: datetime(2024, 3, 2, 0, 0, 1))
    source = str(tmp_path / "late")
    write_log(spark, source, [(0, n, event(n)) for n in range(7, 10)])
    land(store, spark, source, "three")
    monkeypatch.setattr(RawStore, "_read", plain)
    assert store.events().count() == 13
    assert staged() == {n: 1 if n < 8 else 2 for n in range(10)}

    # a copy that landed first and is seen last
    monkeypatch.setattr(RawStore, "_read", hidden)
    landed("four", [9, 10], 58)
    monkeypatch.setattr(RawStore, "_read", plain)
    assert staged() == {n: 2 if n == 8 else 1 for n in range(11)}


def test_lost_checkpoint_in_the_same_group_is_logged_anew(spark, tmp_path):
    source, store = str(tmp_path / "log"), RawStore(spark, str(tmp_path / "raw"))
    write_log(spark, source, [(0, 0, event(1)), (0, 1, event(2))])
    run(spark, source, store, str(tmp_path / "c1"))
    write_log(spark, source, [(0, 2, event(3)), (0, 3, b"{bad")])
    run(spark, source, store, str(tmp_path / "c2"))
    logged = store.batches().orderBy("started_at").collect()
    numbers = [(b.messages_read, b.rows_inserted, b.rows_duplicate, b.rows_rejected) for b in logged]
    assert numbers == [(2, 2, 0, 0), (2, 0, 2, 0), (2, 1, 0, 1)]
    recent = [r.batch_id for r in recent_batches(store.batches()).collect()]
    assert recent == [b.batch_id for b in reversed(logged)]
