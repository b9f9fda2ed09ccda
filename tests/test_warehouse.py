"""Stored relations: full build, incremental run, upserts, checks and reports."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall import schema
from footfall.fixtures import adapter
from footfall.operators import reports
from footfall.plans import models, warehouse


def table(spark, rows, columns="k INT, v STRING, p INT"):
    return spark.createDataFrame(rows, columns)


def contents(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("k", "v", "p").collect())


def test_view(spark):
    assert warehouse.materialize_view(table(spark, [(1, "a", 0)]), "some_view") == 1
    assert warehouse.materialize_view(table(spark, [(1, "a", 0), (2, "b", 0)]), "some_view") == 2
    assert spark.table("some_view").count() == 2


def test_table_can_be_rebuilt_from_itself(spark, databases):
    name = "stg.rebuilt"
    assert warehouse.materialize_table(table(spark, [(1, "a", 0), (2, "b", 0)]), name) == 2
    assert warehouse.materialize_table(spark.table(name).where("k = 2"), name) == 1
    assert contents(spark, name) == [(2, "b", 0)]
    assert not spark.catalog.tableExists(f"{name}__build")


@pytest.mark.parametrize("partition", [None, "p"])
def test_upsert(spark, databases, partition):
    name = f"stg.upserted_{partition}"
    first = table(spark, [(1, "a", 0), (2, "b", 1), (None, "n", 1), (4, "d", 2)])
    assert warehouse.upsert(first, name, ["k"], partition=partition) == 4
    change = table(spark, [(2, "B", 1), (3, "c", 1)])
    assert warehouse.upsert(change, name, ["k"], partition=partition) == 2
    spark.catalog.refreshTable(name)
    expected = {(1, "a", 0), (2, "B", 1), (3, "c", 1), (None, "n", 1), (4, "d", 2)}
    assert {tuple(r) for r in spark.table(name).select("k", "v", "p").collect()} == expected
    assert warehouse.upsert(change.where("false"), name, ["k"], partition=partition) == 0
    assert spark.table(name).count() == 5
    assert warehouse.upsert(change, name, ["k"], full_refresh=True, partition=partition) == 2
    assert spark.table(name).count() == 2


def test_upsert_on_two_keys(spark, databases):
    rows = [(1, "a", 0), (1, "a", 1)]
    warehouse.upsert(table(spark, rows), "stg.two_keys", ["k", "p"])
    warehouse.upsert(table(spark, [(1, "z", 1)]), "stg.two_keys", ["k", "p"])
    assert contents(spark, "stg.two_keys") == [(1, "a", 0), (1, "z", 1)]


def test_upsert_loses_no_row_of_the_null_partition(spark, databases):
    name = "stg.null_partition"
    rows = [(1, "a", None), (2, "b", None), (3, "c", 1), (4, "d", None)]
    warehouse.upsert(table(spark, rows), name, ["k"], partition="p")
    warehouse.upsert(table(spark, [(1, "A", None)]), name, ["k"], partition="p")
    expected = {(1, "A", None), (2, "b", None), (3, "c", 1), (4, "d", None)}
    assert {tuple(r) for r in spark.table(name).select("k", "v", "p").collect()} == expected
    warehouse.upsert(table(spark, [(2, "B", None), (3, "C", 1), (5, "e", 2)]), name, ["k"], partition="p")
    expected = {(1, "A", None), (2, "B", None), (3, "C", 1), (4, "d", None), (5, "e", 2)}
    assert {tuple(r) for r in spark.table(name).select("k", "v", "p").collect()} == expected


@pytest.mark.parametrize("partition", [None, "p"])
def test_a_slice_keeps_one_row_of_a_key(spark, databases, partition):
    name = f"stg.repeated_{partition}"
    first = [(1, "b", 0), (1, "a", 0), (2, "x", 0), (None, "n", 0), (None, "n", 0)]
    warehouse.upsert(table(spark, first), name, ["k"], partition=partition, order=["v"])
    rows = lambda: sorted(map(tuple, spark.table(name).select("k", "v", "p").collect()), key=str)
    assert rows() == [(1, "a", 0), (2, "x", 0), (None, "n", 0), (None, "n", 0)]
    again = [(2, "z", 0), (2, "y", 0), (3, "c", 1), (3, "c", 1)]
    warehouse.upsert(table(spark, again), name, ["k"], partition=partition, order=["v"])
    assert rows() == [(1, "a", 0), (2, "y", 0), (3, "c", 1), (None, "n", 0), (None, "n", 0)]


def test_upsert_removes_copies_from_other_partitions(spark, databases):
    name = "stg.moved"
    warehouse.upsert(table(spark, [(1, "late", 5), (2, "b", 4), (3, "c", 5)]), name, ["k"], partition="p")
    gone = table(spark, [(1, "late", 5), (2, "b", 4)])
    fresh = table(spark, [(1, "first", 3), (2, "first", 3)])
    warehouse.upsert(fresh, name, ["k"], partition="p", gone=gone)
    found = {tuple(r) for r in spark.table(name).select("k", "v", "p").collect()}
    assert found == {(1, "first", 3), (2, "first", 3), (3, "c", 5)}


def test_readers_see_the_old_table_during_a_rebuild(spark, databases):
    for layout in ({}, {"bucket_by": ["k"]}, {"partition_by": ["p"]}):
        name = f"stg.read_{len(str(layout))}"
        old = table(spark, [(1, "old", 0), (2, "old", 1)]).repartition(2)
        warehouse.materialize_table(old, name, **layout)
        reader = spark.table(name).toLocalIterator()
        first = next(reader)
        writes = []

        def seen(rows, name=name, writes=writes):
            # what others see while the new rows are being made
            writes.append(spark.table(name).count())
            return rows

        fresh = seen(table(spark, [(3, "new", 0)]))
        assert warehouse.materialize_table(fresh, name, **layout) == 1
        assert writes == [2] and contents(spark, name) == [(3, "new", 0)]
        assert sorted([first.k, *(r.k for r in reader)]) == [1, 2]  # begun before, read after
        assert warehouse.remove_former(spark, name) == 1
        assert contents(spark, name) == [(3, "new", 0)]
    # other columns
    warehouse.materialize_table(spark.range(3), "stg.read_2")
    assert spark.table("stg.read_2").columns == ["id"]


def status_of(spark, run):
    rows = spark.table("meta.model_runs").where(F.col("run_id") == run).collect()
    return {r.model_name: (r.status, r.rows_affected) for r in rows}


def test_build_test_and_report(spark, databases, sf_dir):
    raw = adapter.raw_events(spark, sf_dir)
    early = raw.where(F.col("ingested_at") < "2024-01-21")
    warehouse.materialize_table(early, "raw.events")
    first = models.build_models(spark, timeout_minutes=1440)
    built = status_of(spark, first)
    assert len(built) == 10 and {s for s, _ in built.values()} == {"success"}
    assert built["stg_events"][1] == early.count()

    # the rest arrives: staging reads it and the last minutes again, without duplicates
    warehouse.materialize_table(raw, "raw.events")
    newest = early.agg(F.max("ingested_at")).first()[0]
    second = models.build_models(spark, timeout_minutes=1440)
    overlap = raw.where(F.col("ingested_at") >= F.lit(newest - timedelta(minutes=15)))
    assert status_of(spark, second)["stg_events"] == ("success", overlap.count())
    assert spark.table("stg.stg_events").count() == raw.count()
    assert spark.table("stg.stg_events").select("event_id").distinct().count() == raw.count()

    full = models.build_models(spark, timeout_minutes=1440, full_refresh=True)
    incremental, rebuilt = status_of(spark, second), status_of(spark, full)
    assert incremental | {"stg_events": None} == rebuilt | {"stg_events": None}

    counts = {r.relation: r.row_count for r in reports.table_counts(spark).collect()}
    assert list(counts) == schema.RELATIONS
    assert counts["mart.fct_sessions"] == rebuilt["fct_sessions"][1]
    last = reports.last_transform_run(spark.table("meta.model_runs")).first()
    assert (last.run_id, last.models, last.succeeded, last.failed) == (full, 10, 10, 0)

    tested = models.test_models(spark)
    log = spark.table("meta.test_results")
    summary = reports.last_test_run(log).first()
    assert (summary.run_id, summary.tests, summary.errored) == (tested, 101, 0)
    broken = reports.failing_tests(log, tested).collect()
    assert len(broken) == summary.failed
    # random test events: the only rules that may break say that people buy in order,
    # that categories are known and that channels or first devices are complete
    assert {r.model_name for r in broken} <= {"dim_page", "dim_product", "agg_daily_traffic"}

    # what was written in session layout is read without shuffling events again
    from plans import main_path

    from footfall.operators.pageviews import fct_page_views

    path = main_path(fct_page_views(spark.table(models.WIDE)))
    assert not [o for o in path if o.startswith("Exchange")]


def test_failures_are_logged_and_dependants_skipped(spark, databases, sf_dir):
    bad = adapter.raw_events(spark, sf_dir).withColumn(
        "payload", F.lit('{"product": {"price_usd": "cheap"}}')
    )
    warehouse.materialize_table(bad, "raw.events")
    run = models.build_models(spark, full_refresh=True)
    found = {name: status for name, (status, _) in status_of(spark, run).items()}
    assert found.pop("stg_events") == "failed"
    assert set(found.values()) == {"skipped"}
    last = reports.last_transform_run(spark.table("meta.model_runs")).first()
    assert (last.failed, last.skipped) == (1, 9)


def test_missing_relations_have_no_count(spark, databases):
    (row,) = reports.table_counts(spark, ["mart.nowhere"]).collect()
    assert row.row_count is None


def test_report_logs(spark):
    at = datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("r1", "success", at), ("r2", "failed", at + timedelta(1)), ("r2", "success", at)],
        "run_id STRING, status STRING, started_at TIMESTAMP",
    ).withColumn("finished_at", F.col("started_at"))
    last = reports.last_transform_run(runs).first()
    assert (last.run_id, last.models, last.succeeded, last.failed) == ("r1", 1, 1, 0)
    assert reports.last_transform_run(runs.where("false")).count() == 0


def test_upsert_reads_touched_partitions_only(spark, databases):
    from plans import physical

    days = spark.range(300).select(
        "id", F.expr("date_add(DATE'2024-01-01', int(id / 10))").alias("day")
    )
    warehouse.upsert(days, "stg.by_day", ["id"], partition="day")
    fresh = days.where("day BETWEEN '2024-01-28' AND '2024-01-29'")
    touched = warehouse.touched_partitions(spark.table("stg.by_day"), fresh, "day")
    scan = next(line for line in physical(touched) if "by_day" in line)
    filters = scan[scan.index("PartitionFilters") :]
    assert ">= 2024-01-28" in filters and "<= 2024-01-29" in filters
    assert warehouse.upsert(fresh, "stg.by_day", ["id"], partition="day") == 20
    assert spark.table("stg.by_day").count() == 300


def test_totals_beyond_ten_billion(spark):
    from footfall.operators.traffic import daily_traffic

    sessions = spark.range(300).selectExpr(
        "DATE'2024-01-01' AS session_date", "'direct' AS channel", "'mobile' AS device_type",
        "string(id) AS anonymous_id", "1L AS events", "1L AS page_views", "0L AS searches",
        "false AS is_bounce", "true AS viewed_product", "true AS added_to_cart",
        "true AS started_checkout", "true AS purchased", "1L AS orders",
        "CAST(9000000000.01 AS DECIMAL(28,2)) AS revenue_usd", "10 AS duration_seconds",
    )
    row = daily_traffic(sessions).first()
    assert str(row.revenue_usd) == "2700000000003.00"
    assert str(row.avg_order_value_usd) == "9000000000.01"


def test_unique_rows_are_not_moved(spark):
    from plans import physical

    rows = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    assert not any("Exchange" in line for line in physical(warehouse.one_per_key(rows, ["k"])))
    twice = warehouse.one_per_key(rows.union(rows), ["k"])
    assert sorted(map(tuple, twice.collect())) == [(i, 2 * i) for i in range(100)]
