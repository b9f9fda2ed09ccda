"""The event log (Kafka) as a streaming source, a bounded source and a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from footfall import schema
from footfall.sources.messages import validate_events


def read_event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    batch_messages: int = 1_000_000,
) -> DataFrame:
    """Streaming messages; a new Kafka query starts at the earliest offset.

    `fmt` may be a file format holding the same columns, as the tests use. A micro-batch
    reads about `batch_messages` messages and the next one goes on from there; for files,
    set maxFilesPerTrigger.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
        reader = reader.option("maxOffsetsPerTrigger", batch_messages)
    else:
        reader = reader.schema(schema.LOG_MESSAGE)
    return reader.options(**(options or {})).load()


def read_event_batch(
    spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None
) -> DataFrame:
    """A bounded read of the log; end it early with endingOffsets."""
    reader = spark.read.format(fmt)
    if fmt != "kafka":
        reader = reader.schema(schema.LOG_MESSAGE)
    return reader.options(**(options or {})).load()


def publish_projection(messages: DataFrame) -> DataFrame:
    """Valid messages as (key, value, occurred_at), keyed by visitor.

    The same rules as on reading decide what is valid. Spark's Kafka sink sets the
    record time itself, so the event time stays in the value.
    """
    valid = validate_events(messages).where(F.col("error").isNull())
    return valid.select(
        F.col("anonymous_id").alias("key"), F.col("payload").alias("value"), "occurred_at"
    )


def publish_counts(messages: DataFrame) -> DataFrame:
    """How many messages would be published and how many are invalid."""
    return validate_events(messages).agg(*_counts())


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("error").isNull()).alias("produced"),
        F.count_if(F.col("error").isNotNull()).alias("invalid"),
    ]


def publish_writer(
    messages: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None
) -> DataFrameWriter:
    """Writer for the publishable messages; `.save()` sends them."""
    rows = publish_projection(messages).select("key", "value")
    return rows.write.format(fmt).options(**(options or {}))


def publish(
    messages: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None
) -> dict[str, int]:
    """Send the valid messages; returns how many were sent (produced) and how many are invalid.

    Both are counted while the messages are written, so each is validated once.
    """
    counts = Observation()
    validated = validate_events(messages).observe(counts, *_counts())
    valid = validated.where(F.col("error").isNull())
    sent = valid.select(F.col("anonymous_id").alias("key"), F.col("payload").alias("value"))
    sent.write.format(fmt).mode("append").options(**(options or {})).save()
    return counts.get
