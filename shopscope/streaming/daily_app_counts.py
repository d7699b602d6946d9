"""Incremental daily app counters with Structured Streaming.

The batch report recomputes sessions, purchases and first opens over the
whole event history on every run.  This stream keeps the same per
(event day, country) counters (:func:`shopscope.operators.mobile.daily_counts`)
as streaming-aggregation state and folds in only the event files that
arrived since the last trigger.

* State is one row per (day, country): it grows with the calendar, not with
  the event volume, so no watermark is needed and late events for old days
  are still counted (as a full recomputation would count them).
* Every trigger publishes the complete counter table (small) as a new version
  folder and then notes the version; readers take the last noted one
  (:func:`latest_counts`), so a report never reads a table that is being
  replaced.  A batch that is run again rewrites its own version.
* Progress and state live in the checkpoint location, by default
  ``<spark.checkpoint.dir>/streams/daily_app_counts``.

:func:`shopscope.operators.mobile.mobile_report` accepts
:func:`latest_counts` as ``daily=``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.mobile import daily_counts

STREAM_NAME = "daily_app_counts"


def default_checkpoint(spark: SparkSession, name: str = STREAM_NAME) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir (a shared folder) or pass checkpoint_location")
    return f"{root.rstrip('/')}/streams/{name}"


def latest_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """The counter table of the last published version."""
    version = spark.read.parquet(f"{output_path}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{output_path}/counts/{version}")


def start_daily_counts(
    raw_events: DataFrame,
    to_app_events: Callable[[DataFrame], DataFrame],
    output_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the counter stream.

    ``raw_events`` is a streaming DataFrame (e.g. ``spark.readStream.schema(s)
    .parquet(dir)``) and ``to_app_events`` the row-wise projection to the
    nested app-event schema.  With ``available_now`` the query processes every
    file present and stops (a scheduled incremental run); otherwise it runs
    continuously with ``processing_time`` triggers.
    """
    spark = raw_events.sparkSession
    counts = daily_counts(to_app_events(raw_events))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_path}/counts/{batch_id}")
        noted = batch.sparkSession.createDataFrame([(batch_id,)], "version long")
        noted.coalesce(1).write.mode("append").parquet(f"{output_path}/published")

    writer = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint_location or default_checkpoint(spark))
        .queryName(STREAM_NAME)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
