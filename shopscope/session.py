"""Spark session construction and lineage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every job expects.  AQE re-plans joins from runtime sizes, merges
# small shuffle partitions and splits skewed ones; the session time zone only
# matters for display since every timestamp handled here is TIMESTAMP_NTZ.
#
# Broadcasts: the planner's static size estimates (file size scaled by the
# projection) are not a bound on in-memory size, so estimate-based broadcast
# is off.  A join side is broadcast either by an explicit hint after a row
# count (operators.joins.bounded_broadcast) or by AQE when the measured
# shuffle output of that side is under 32 MB.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "shopscope",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset so that spark-submit decides; size
    ``shuffle_partitions`` to roughly (shuffled bytes / 128 MB) and let AQE
    coalesce from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SHOPSCOPE_LOG_LEVEL", "ERROR"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any.

    The folder is read from ``spark.checkpoint.dir``; this library never
    invents one (tests set it when it is unset).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        try:
            spark.sparkContext.setCheckpointDir(folder)
        except Exception:  # a remote (Connect) session has no SparkContext; the server owns the folder
            return None
    return folder


def work_folder(spark: SparkSession) -> str:
    """A new folder for tables of one run, in the cluster's checkpoint folder (beside the warehouse where it is unset)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/shopscope-{uuid.uuid4().hex}"


def reusable(df: DataFrame) -> DataFrame:
    """Make ``df`` cheap to read several times and robust to executor loss.

    With a shared checkpoint folder the rows are written there (reliable
    checkpoint, lineage cut).  Without one the frame is persisted to memory
    and disk; lost blocks are then recomputed from lineage.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
