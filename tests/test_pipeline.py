"""From log messages to tested marts."""

from pyspark.sql import functions as F

from footfall.fixtures import adapter
from footfall.operators import reports
from footfall.plans.pipeline import run_pipeline
from footfall.sources.log import read_event_stream
from footfall.streaming.ingest import RawStore


def test_pipeline(spark, databases, sf_dir, tmp_path):
    sent = adapter.messages(spark, sf_dir, redelivered=True).select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("message_key").alias("key"),
        F.col("message_value").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
    sent.write.parquet(str(tmp_path / "log"))
    store = RawStore(spark, str(tmp_path / "raw"))

    def run():
        stream = read_event_stream(spark, "parquet", {"path": str(tmp_path / "log")})
        return run_pipeline(
            spark, stream, store, str(tmp_path / "checkpoint"), "g", timeout_minutes=1440
        )

    built, tested = run()
    valid = store.events().count()
    assert spark.table("stg.stg_events").count() == valid
    assert valid + store.dead_letters().where("kafka_offset < 1000000000").count() == 1000
    overview = reports.ingest_overview(store.events(), store.dead_letters()).first()
    assert overview.events == valid and overview.dead_letters == store.dead_letters().count()
    last = reports.last_transform_run(spark.table("meta.model_runs")).first()
    assert (last.run_id, last.succeeded) == (built, 10)
    assert reports.last_test_run(spark.table("meta.test_results")).first().run_id == tested

    sessions = spark.table("mart.fct_sessions").count()
    run()  # nothing new arrived
    assert spark.table("stg.stg_events").count() == valid
    assert spark.table("mart.fct_sessions").count() == sessions
