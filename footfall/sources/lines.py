"""Newline-delimited JSON files as a source and a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.timestamps import is_blank, strip


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as messages for `validate_events`; files have no offsets."""
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    return lines.select(
        F.lit(None).cast("string").alias("kafka_topic"),
        F.lit(None).cast("int").alias("kafka_partition"),
        F.lit(None).cast("bigint").alias("kafka_offset"),
        F.lit(None).cast("binary").alias("message_key"),
        strip(F.col("value")).cast("binary").alias("message_value"),
    )


def write_json_lines(events: DataFrame, path: str, payload: str = "payload") -> None:
    """One compact JSON document per line."""
    compact = F.to_json(F.parse_json(F.col(payload)))
    events.select(compact.alias("value")).write.text(path)
