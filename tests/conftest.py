import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[*]")
        .appName("shopscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shopscope-warehouse-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests run locally: name a checkpoint folder only when none is configured.
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shopscope-ckpt-", dir="/tmp"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def oracle_small():
    from shopscope.checks.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="session")
def oracle_mid():
    from shopscope.checks.compare import duckdb_connection

    return duckdb_connection(SF_MID)
