"""Ingest, build and test in one go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.plans.models import build_models, test_models
from footfall.streaming.ingest import RawStore, start_ingest


def run_pipeline(
    spark: SparkSession,
    stream: DataFrame,
    store: RawStore,
    checkpoint: str,
    group: str,
    **build_options,
) -> tuple[str, str | None]:
    """Land what the stream holds now, build all models, test them.

    Returns the run ids of the build and of the tests; tests are left out only if no
    model could be built.
    """
    start_ingest(stream, store, checkpoint, group).awaitTermination()
    built = build_models(spark, raw=store.events(), ids=store.ids(), **build_options)
    outcome = spark.table("meta.model_runs").where(
        (F.col("run_id") == built) & (F.col("status") == "success")
    )
    return built, None if outcome.isEmpty() else test_models(spark)
