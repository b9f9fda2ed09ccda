"""Streaming ingest: micro-batches of log messages into the raw tables.

A batch of a stream owns a folder in each raw table and writes it whole, so that it can run again
after a failure and leaves the same rows. Ids that landed are kept a second time as narrow rows,
dealt to buckets by hash; a batch reads the buckets of its own ids and the dead letters of its own
stretches of the log, and nothing else of the past.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from footfall import schema
from footfall.plans.warehouse import now
from footfall.sources import messages as msg

#: Folders that the ids of landed events are dealt to.
BUCKETS = 64
#: Offsets of a partition of the log whose dead letters share a folder.
STRETCH = 1_000_000
STREAM = ", stream_id STRING"
IDS = (
    "event_id STRING, ingested_at TIMESTAMP, kafka_partition INT, kafka_offset BIGINT, "
    "stream_id STRING, batch_id BIGINT, bucket INT, batch STRING"
)


@dataclass
class RawStore:
    """The raw tables as Parquet folders under one root on shared storage.

    `buckets` belongs to the store and must not change; a batch writes at most so many files of ids.
    """

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def events(self) -> DataFrame:
        return self._read("events", schema.RAW_EVENTS + STREAM + ", ingest_date DATE, batch STRING").drop("batch")

    def dead_letters(self, places: list[str] | None = None) -> DataFrame:
        """Rejected messages, of some stretches of the log or all."""
        folders = None if places is None else [f"place={p}" for p in places]
        columns = schema.DEAD_LETTERS + STREAM + ", place STRING, batch STRING"
        return self._read("dead_letters", columns, folders).drop("place", "batch")

    def batches(self) -> DataFrame:
        """One row per batch: as committed, else as begun."""
        logged = self._read(
            "batches", schema.INGEST_BATCHES + STREAM + ", stream STRING, batch STRING, state STRING"
        )
        latest = Window.partitionBy("stream_id", "batch_id").orderBy("state")
        return (
            logged.withColumn("_nth", F.row_number().over(latest))
            .where("_nth = 1")
            .drop("_nth", "stream", "batch", "state")
        )

    def ids(self, buckets: list[int] | None = None) -> DataFrame:
        """Ids of landed events and where their copy came from, of some buckets or all.

        An id is there twice only if two streams landed it at the same moment.
        """
        places = None if buckets is None else [f"bucket={b}" for b in buckets]
        return self._read("ids", IDS, places).drop("batch")

    def _read(self, name: str, columns: str, places: list[str] | None = None) -> DataFrame:
        base = f"{self.root}/{name}"
        reader = self.spark.read.schema(columns).option("basePath", base)
        found = []
        for place in [""] if places is None else places:
            try:  # folders that don't exist yet hold nothing
                found.append(reader.parquet(f"{base}/{place}"))
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
        if not found:
            return self.spark.createDataFrame([], columns)
        whole = found[0]
        for more in found[1:]:
            whole = whole.union(more)
        return whole

    def land(
        self, messages: DataFrame, batch_id: int, group: str, stream: str | None = None
    ) -> None:
        """Store one batch: new events, their ids, dead letters, then the batch row.

        (stream, batch_id) names the batch; by default the stream is the group. A batch that runs
        again replaces what it wrote.
        """
        batch = _Batch(self, stream or group, batch_id, group)
        validated = msg.validate_events(msg.from_log(messages)).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint")
        )
        validated.persist()
        try:
            batch.begin(validated)
            batch.land_events(validated)
            batch.land_dead_letters(validated)
            batch.commit(validated)
        finally:
            validated.unpersist()


class _Batch:
    """What one batch of a stream writes."""

    def __init__(self, store: RawStore, stream: str, batch_id: int, group: str) -> None:
        self.store, self.stream, self.batch_id, self.group = store, stream, batch_id, group
        self.stream_key = hashlib.sha256(stream.encode()).hexdigest()[:32]
        self.key = f"{self.stream_key}-{batch_id}"
        self.log = f"stream={self.stream_key}/batch={self.key}"
        self.started_at = now()

    def begin(self, validated: DataFrame) -> None:
        """Log the batch as running, or learn from the log when it began first: its day is kept."""
        logged = schema.INGEST_BATCHES + STREAM + ", stream STRING, batch STRING, state STRING"
        before = self.store._read("batches", logged, [self.log])
        first = before.agg(F.min("started_at")).first()[0]
        if first is not None:
            self.started_at = first.astimezone(timezone.utc)
            return
        topics = validated.select(F.col("kafka_topic").alias("topic")).distinct()
        self._log(topics, "running", None)

    def land_events(self, validated: DataFrame) -> None:
        valid = validated.where(F.col("error").isNull())
        found = valid.select(self._bucket().alias("bucket")).distinct().collect()  # at most all buckets
        known = self.store.ids(sorted(r.bucket for r in found)).where(~self._own())
        events = msg.first_offset(msg.valid_events(valid))
        # only the ids of this batch are looked for; Spark picks the join by measured size
        landed = known.join(valid.select("event_id"), "event_id", "left_semi")
        new = msg.unseen(events, landed).withColumn("ingested_at", F.lit(self.started_at))
        self._write(
            new.select(
                *schema.names(schema.RAW_EVENTS),
                F.lit(self.stream).alias("stream_id"),
                F.to_date("ingested_at").alias("ingest_date"),
            ),
            "events",
            ["ingest_date"],
        )
        ids = self.own_events().select(
            "event_id", "ingested_at", "kafka_partition", "kafka_offset", "stream_id", "batch_id",
            self._bucket().alias("bucket"),
        )
        self._write(ids.repartition("bucket"), "ids", ["bucket"])

    def own_events(self) -> DataFrame:
        """The events of this batch, from its own folder."""
        columns = schema.RAW_EVENTS + STREAM + ", ingest_date DATE, batch STRING"
        day = self.started_at.astimezone(timezone.utc).date()
        return self.store._read("events", columns, [f"ingest_date={day}/batch={self.key}"])

    def land_dead_letters(self, validated: DataFrame) -> None:
        """Rejected messages that no other batch has: looked for in their stretches of the log only."""
        stretch = F.floor(F.col("kafka_offset") / STRETCH).cast("string")
        rejected = msg.dead_letters(validated).withColumn(
            "place", F.concat_ws("-", F.col("kafka_partition").cast("string"), stretch)
        )
        places = sorted(r.place for r in rejected.select("place").distinct().collect())
        known = self.store.dead_letters(places).where(~self._own()).select(*msg.ENVELOPE)
        new = rejected.join(known, msg.ENVELOPE, "left_anti").withColumns(
            {"rejected_at": F.lit(self.started_at), "stream_id": F.lit(self.stream)}
        )
        columns = schema.names(schema.DEAD_LETTERS + STREAM)
        self._write(new.select(*columns, "place"), "dead_letters", ["place"])

    def commit(self, validated: DataFrame) -> None:
        # Counted from what is stored, so a repeated batch logs the same numbers.
        self._log(msg.ingest_batch_stats(validated, self.own_events()), "committed", now())

    def _own(self) -> Column:
        return (F.col("stream_id") == self.stream) & (F.col("batch_id") == self.batch_id)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.store.buckets)).cast("int")

    def _log(self, rows: DataFrame, state: str, finished_at: datetime | None) -> None:
        given = {
            "batch_id": F.lit(self.batch_id),
            "consumer_group": F.lit(self.group),
            "started_at": F.lit(self.started_at),
            "finished_at": F.lit(finished_at).cast("timestamp"),
            "status": F.lit(state),
            "error": F.lit(None).cast("string"),
            "stream_id": F.lit(self.stream),
        }
        row = rows.withColumns(given)
        fields = StructType.fromDDL(schema.INGEST_BATCHES + STREAM)
        (
            row.select(
                *((F.col(f.name) if f.name in row.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                  for f in fields)
            )
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.store.root}/batches/{self.log}/state={state}")
        )

    def _write(self, rows: DataFrame, table: str, partitions: list[str]) -> None:
        """Replace what this batch has in a table."""
        (
            rows.withColumn("batch", F.lit(self.key))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions, "batch")
            .parquet(f"{self.store.root}/{table}")
        )


def first_copies(events: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of events that two streams landed at the same moment, those that landed first; and the others.

    `ids` is the store's list of landed ids. Only ids of `events` that are there twice are looked
    at, so payloads are shuffled only where these are many.
    """
    place = F.struct("ingested_at", "kafka_offset", "kafka_partition", "stream_id")
    copies = (
        ids.join(events.select("event_id"), "event_id", "left_semi")
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("_first"))
        .where("n > 1")
        .drop("n")
    )
    marked = events.join(copies, "event_id", "left")
    later = F.coalesce(F.col("_first") != place, F.lit(False))
    return marked.where(~later).drop("_first"), marked.where(later).drop("_first")


def batch_number(query: str, stream_batch: int) -> int:
    """A number for a batch that is the same when it repeats and rises within its stream.

    `query` is the stream's id, which its checkpoint holds: a new checkpoint is a new stream, also
    in the same group, so its batches are logged anew. Two streams may have equal numbers; the
    stored rows carry the stream's id beside it.
    """
    digest = hashlib.sha256(query.encode()).digest()
    return (int.from_bytes(digest[:4], "big") >> 1 << 32) + stream_batch


def start_ingest(
    stream: DataFrame,
    store: RawStore,
    checkpoint: str,
    group: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest a message stream; by default all there is now, then stop.

    `trigger={"processingTime": "5 seconds"}` keeps it running. The checkpoint holds
    the read position, so a restart continues where the last whole batch ended.
    """

    def land(batch: DataFrame, number: int) -> None:
        # a stream's id is kept in its checkpoint
        query = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        store.land(batch, batch_number(query, number), group, query)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
