import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")

    from footfall.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="module")
def databases(spark):
    """Empty databases for the stored tables of one test module."""
    from footfall.plans import warehouse

    for name in ("raw", "stg", "mart", "meta"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    warehouse.create_databases(spark)
