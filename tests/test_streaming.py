"""The incremental counters equal the batch counters."""

import os
from collections import Counter
import shutil
import tempfile

from shopscope.operators import mobile as M
from shopscope.sources.fixtures import FixtureInputs, app_events_from_raw
from shopscope.streaming.daily_app_counts import latest_counts, start_daily_counts

from .conftest import SF_SMALL


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stream_counts_match_batch_and_accumulate(spark):
    work = tempfile.mkdtemp(prefix="shopscope-stream-", dir="/tmp")
    landing = os.path.join(work, "landing")
    os.makedirs(landing)
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    first, second = raw.randomSplit([0.5, 0.5], seed=3)
    first.write.parquet(os.path.join(landing, "day1"))
    stream = spark.readStream.schema(raw.schema).parquet(os.path.join(landing, "*"))
    out = os.path.join(work, "counts")
    ckpt = os.path.join(work, "ckpt")

    start_daily_counts(stream, app_events_from_raw, out, ckpt).awaitTermination()
    assert _rows(latest_counts(spark, out)) == _rows(M.daily_counts(app_events_from_raw(first)))

    # a second delivery is folded into the kept state
    second.write.parquet(os.path.join(landing, "day2"))
    start_daily_counts(stream, app_events_from_raw, out, ckpt).awaitTermination()
    batch = M.daily_counts(FixtureInputs(spark, SF_SMALL).app_events)
    assert _rows(latest_counts(spark, out)) == _rows(batch)

    # the report built from the stored counters equals the full recomputation
    inputs = FixtureInputs(spark, SF_SMALL)
    stored = M.mobile_report(inputs.app_events, inputs.date_dimension, daily=latest_counts(spark, out))
    full = M.mobile_report(inputs.app_events, inputs.date_dimension)
    assert _rows(stored) == _rows(full)
    shutil.rmtree(work, ignore_errors=True)


def test_report_for_a_date_range_equals_the_full_report_restricted(spark):
    from datetime import date

    from pyspark.sql import functions as F

    inputs = FixtureInputs(spark, SF_SMALL)
    full = M.mobile_report(inputs.app_events, inputs.date_dimension)
    part = M.mobile_report(inputs.app_events, inputs.date_dimension, first_day=date(2024, 1, 10), last_day=date(2024, 1, 20))
    expected = full.filter(F.col("event_date").between(date(2024, 1, 10), date(2024, 1, 20)))
    assert part.count() > 0
    assert _rows(part) == _rows(expected)
