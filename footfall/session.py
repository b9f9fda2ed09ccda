"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two, so they are set on every session.
REQUIRED = {
    # Session ids and dates are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# The JVM never compiles longer methods; Spark then evaluates the stage's expressions in short ones.
SPEED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators need; leaves sizing to the cluster."""
    for key, value in (REQUIRED | SPEED).items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in spark.checkpoint.dir.

    Where that setting is empty, a session with local[...] as its master gets a folder of its own,
    since driver and tasks share one machine; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/footfall/{uuid.uuid4()}/{name}"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        zipped = f"{tempfile.mkdtemp(prefix='footfall-')}/{package.name}.zip"
        with zipfile.ZipFile(zipped, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(zipped)
        _shipped.add(context.applicationId)


_shipped: set[str] = set()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the shared scratch folder and read it back.

    Used where one relation feeds several later ones. The files outlive lost
    executors, and later readers still prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
