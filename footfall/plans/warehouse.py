"""Storing relations: views, full rebuilds, keyed upserts and run logs."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall import schema
from footfall.session import stage


def create_databases(spark: SparkSession, root: str | None = None) -> None:
    """Create those that are missing, under `root` or in the session's warehouse."""
    for name in ("raw", "stg", "mart", "meta"):
        place = f" LOCATION '{root}/{name}.db'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def materialize_view(df: DataFrame, name: str) -> int:
    """(Re)create a session view; returns its row count."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name).count()


def materialize_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> int:
    """Rebuild a table; returns its row count.

    The rows are written once, to a new folder, and the catalog is then pointed to it: the table's
    location is changed, or, if its columns or layout differ or it has partitions, it is dropped and
    the new one takes its name. Neither moves nor deletes files of tables made here, so who reads the
    table meanwhile, or has begun to, sees the old one to the end. `bucket_by` lays the files out by those columns,
    so that later joins, groups and windows on them read without a shuffle.

    Former folders stay until `remove_former` is called.
    """
    spark = df.sparkSession
    build, folder = f"{name}__build", _new_folder(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {build}")
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer.option("path", folder).saveAsTable(build)
    if not partition_by and _layout(spark, name) == _layout(spark, build):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {build}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {build} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return written.get["rows"]


def _new_folder(spark: SparkSession, name: str) -> str:
    """A folder for a version of a table, in that of its database."""
    database, table = name.split(".") if "." in name else (spark.catalog.currentDatabase(), name)
    root = spark.catalog.getDatabase(database).locationUri
    return f"{root.rstrip('/')}/{table}__versions/{uuid.uuid4().hex}"


def _description(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name}


def _layout(spark: SparkSession, name: str) -> tuple | None:
    """Columns, buckets, partitions; null for a table that isn't there or a view."""
    if not spark.catalog.tableExists(name):
        return None
    told = _description(spark, name)
    if told.get("Type") == "VIEW":
        return None
    parts = [told.get(k) for k in ("Num Buckets", "Bucket Columns", "Sort Columns", "# Partition Information")]
    return (spark.table(name).schema.simpleString(), told.get("Provider"), *parts)


def remove_former(spark: SparkSession, name: str) -> int:
    """Delete the folders of former versions of a table, once nobody reads them; returns how many."""
    now_at = _description(spark, name)["Location"].rstrip("/")
    versions = _new_folder(spark, name).rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(versions)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    former = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
    gone = [p for p in former if p.getName() != now_at.rsplit("/", 1)[1]]
    for folder in gone:
        files.delete(folder, True)
    return len(gone)


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of each key by `order`, or by a hash of the row; rows with a null key all stay.

    Keys that occur more than once are found first, from the keys alone; where there are none, as is
    usual, no row is moved. Otherwise only theirs are sorted.
    """
    order = order or []
    whole = ~F.lit(False)
    for k in keys:
        whole &= F.col(k).isNotNull()
    repeated = df.where(whole).groupBy(keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeated = stage(repeated, "repeated_keys")
    if repeated.isEmpty():
        return df
    rank = F.struct(*order, F.xxhash64(*df.columns))
    rest = [c for c in df.columns if c not in keys]
    first = (
        df.join(repeated, keys, "left_semi")
        .groupBy(keys)
        .agg(F.min_by(F.struct(*rest), rank).alias("_row"))
        .select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
    return df.join(repeated, keys, "left_anti").select(*df.columns).union(first)


def merged(
    target: DataFrame, slice_: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """`target` without the keys of `slice_`, plus `slice_`: its rows replace theirs.

    Of several rows of the slice with one key, the first by `order` is taken.
    """
    fresh = one_per_key(slice_, keys, order)
    kept = target.join(slice_.select(*keys), keys, "left_anti")
    return kept.select(*slice_.columns).unionByName(fresh)


def touched_partitions(target: DataFrame, slice_: DataFrame, partition: str) -> DataFrame:
    """Rows of `target` in the partitions that `slice_` has rows for, null being one of them.

    The range of the slice's partitions is one row, read first and given to the scan as literals,
    so that folders outside it are not even listed as tasks; the join drops those in between.
    """
    low, high, none = slice_.agg(
        F.min(partition), F.max(partition), F.bool_or(F.col(partition).isNull())
    ).first()
    near = F.col(partition).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    if none:
        near |= F.col(partition).isNull()
    listed = slice_.select(F.col(partition).alias("_partition")).distinct()
    return target.where(near).join(
        listed, F.col(partition).eqNullSafe(F.col("_partition")), "left_semi"
    )


def upsert(
    df: DataFrame,
    name: str,
    keys: list[str],
    full_refresh: bool = False,
    partition: str | None = None,
    order: list[str] | None = None,
    gone: DataFrame | None = None,
) -> int:
    """Replace the rows of `name` whose key is in `df` and add the rest; returns the rows of `df`.

    Of several rows with one key the first by `order` is kept; rows with a null key are always
    added. The first run and a full refresh rebuild the table. With `partition`, a column that
    never changes for a key (such as the ingest date), only the partitions `df` touches are read
    and rewritten; otherwise the whole table is. `gone` holds rows like those of `df` whose keys
    may stand in other partitions than `df` has them in; they are removed there.
    """
    spark = df.sparkSession
    parts = [partition] if partition else None
    if full_refresh or not spark.catalog.tableExists(name):
        return materialize_table(one_per_key(df, keys, order), name, partition_by=parts)

    slice_name, gone_name, build = (f"{name}__{what}" for what in ("slice", "gone", "merged"))
    rows = materialize_table(df, slice_name)
    others = df.limit(0) if gone is None else gone.select(*df.columns)
    removed = materialize_table(others, gone_name)
    if rows or removed:
        slice_, others, target = (spark.table(t) for t in (slice_name, gone_name, name))
        touched = target if partition is None else touched_partitions(
            target, slice_.union(others), partition
        )
        result = merged(touched.join(others.select(*keys), keys, "left_anti"), slice_, keys, order)
        if partition is None:
            materialize_table(result, name)
        else:
            materialize_table(result.select(*target.columns), build)
            _overwrite_partitions(spark, build, name)
            _drop_emptied(touched, spark.table(build), name, partition)
    for scratch in (slice_name, gone_name, build):
        _drop_with_files(spark, scratch)
    return rows


def _drop_with_files(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        remove_former(spark, name)
        path = spark._jvm.org.apache.hadoop.fs.Path(_description(spark, name)["Location"])
        spark.sql(f"DROP TABLE {name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _overwrite_partitions(spark: SparkSession, source: str, name: str) -> None:
    """Replace the partitions that table `source` has rows for and no others.

    The mode is a setting of the session, so it is set in a session made for this write.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.table(source).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def _drop_emptied(touched: DataFrame, left: DataFrame, name: str, partition: str) -> None:
    """Partitions of which no row is left, which an overwrite does not replace."""
    before = touched.select(F.col(partition).alias("p")).distinct()
    after = left.select(F.col(partition).alias("q")).distinct()
    emptied = before.join(after, F.col("p").eqNullSafe(F.col("q")), "left_anti")
    for row in emptied.select(F.col("p").cast("string")).collect():  # one for each such partition
        value = "null" if row.p is None else f"'{row.p}'"
        touched.sparkSession.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition}={value})")


def _append(spark: SparkSession, name: str, row: dict, columns: str) -> None:
    spark.createDataFrame([row], columns).write.mode("append").saveAsTable(name)


def now() -> datetime:
    return datetime.now(timezone.utc)


def log_model_run(
    spark: SparkSession,
    run_id: str,
    model: str,
    materialized: str,
    status: str,
    started_at: datetime,
    rows: int | None = None,
    full_refresh: bool = False,
    error: str | None = None,
) -> None:
    _append(
        spark,
        "meta.model_runs",
        {
            "model_run_id": str(uuid.uuid4()),
            "run_id": run_id,
            "model_name": model,
            "materialized": materialized,
            "started_at": started_at,
            "finished_at": now(),
            "status": status,
            "rows_affected": rows,
            "full_refresh": full_refresh,
            "error": error,
        },
        schema.MODEL_RUNS,
    )


def log_test_results(results: DataFrame, run_id: str, name: str = "meta.test_results") -> None:
    """Append check results, one row each, under one run id."""
    results.select(
        F.uuid().alias("test_result_id"),
        F.lit(run_id).alias("run_id"),
        "model_name",
        "column_name",
        "test_name",
        "status",
        "failing_rows",
        F.lit(now()).alias("executed_at"),
        "error",
    ).write.mode("append").saveAsTable(name)
