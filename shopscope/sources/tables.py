"""Readers for the parquet tables the jobs start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table stored as ``<root>/<name>.parquet`` (a file or a directory).

    Parquet keeps the scan columnar: the planner prunes unused columns and
    pushes simple predicates into the reader (row-group skipping).
    """
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
