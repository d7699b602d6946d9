"""Event shards: names, range, columns that drift, plans."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopscope.operators import mobile as M
from shopscope.session import work_folder
from shopscope.sources import shards
from shopscope.sources.fixtures import FixtureInputs
from shopscope.sources.schema import APP_EVENTS

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return FixtureInputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def days(inputs):
    return sorted(r[0] for r in inputs.app_events.select("event_date").distinct().collect())[:3]


@pytest.fixture(scope="module")
def drifting(spark, inputs, days):
    """Three shards: one as it should be, one older and narrower, one newer with more fields and no date."""
    root = work_folder(spark)
    of_day = lambda d: inputs.app_events.filter(F.col("event_date") == d)
    of_day(days[0]).write.parquet(f"{root}/events_{days[0]}")
    value = lambda x, *more: F.struct(x["key"].alias("key"), F.struct(x["value"]["string_value"].alias("string_value"), *more).alias("value"))
    narrow = lambda x: value(x, x["value"]["int_value"].cast("bigint").alias("int_value"))
    old = of_day(days[1]).select(
        F.struct("geo.country").alias("geo"),
        F.transform("user_properties", narrow).alias("user_properties"),
        F.transform("event_params", lambda x: value(x)).alias("event_params"),
        F.col("user_pseudo_id").cast("bigint").alias("user_pseudo_id"),
        F.col("event_value_in_usd").cast("decimal(9,2)").alias("event_value_in_usd"),
        "event_name",
        "event_timestamp",
    )
    old.write.parquet(f"{root}/events_{days[1]}")
    new = of_day(days[2]).drop("event_date").select(
        F.lit("extra").alias("platform"),
        F.struct(F.lit("EU").alias("continent"), F.col("geo.country").alias("country")).alias("geo"),
        F.transform("event_params", lambda x: F.struct(F.lit(1).alias("rank"), x["value"].alias("value"), x["key"].alias("key"))).alias("event_params"),
        *[c for c in APP_EVENTS.fieldNames() if c not in ("event_date", "geo", "event_params")],
    )
    new.write.parquet(f"{root}/events_{days[2]}")
    for other in ("events_intraday_20240101", "events_2024", "eventsX20240101"):
        inputs.app_events.limit(1).write.parquet(f"{root}/{other}")
    return f"{root}/events_*"


def test_names_and_range(spark, drifting, days):
    found = shards.folder_shards(spark, drifting)
    assert list(found) == days
    day = lambda d: date(int(d[:4]), int(d[4:6]), int(d[6:]))
    assert list(shards.in_range(found, day(days[1]))) == days[1:]
    assert list(shards.in_range(found, None, day(days[1]))) == days[:2]
    assert list(shards.in_range(found, day(days[1]), day(days[1]))) == [days[1]]
    with pytest.raises(ValueError):
        shards.read_shards(spark, "events")


def test_report_over_drifting_shards_equals_one_table(spark, inputs, drifting, days):
    whole = inputs.app_events.filter(F.col("event_date").isin(days))
    got = shards.read_shards(spark, drifting)
    assert got.schema.simpleString() == APP_EVENTS.simpleString()
    want = [tuple(r) for r in M.mobile_report(whole, inputs.date_dimension).collect()]
    assert [tuple(r) for r in M.mobile_report(got, inputs.date_dimension).collect()] == want and want


def _scanned(df):
    return {p.rsplit("_", 1)[1][:8] for p in df.inputFiles()}


def test_only_needed_shards_are_in_the_plan(spark, drifting, days):
    events = shards.read_shards(spark, drifting)
    plan = events.filter(F.col("event_date") >= days[2])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1
    plan = events.filter((F.col("event_date") >= days[1]) & (F.col("event_name") == "session_start"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 2
    first = date(int(days[1][:4]), int(days[1][4:6]), int(days[1][6:]))
    assert _scanned(shards.read_shards(spark, drifting, first=first)) == set(days[1:])
    assert shards.read_shards(spark, drifting, first=date(2999, 1, 1)).count() == 0


def test_catalog_shards(spark, inputs, days):
    for d in days:
        inputs.app_events.filter(F.col("event_date") == d).write.mode("overwrite").saveAsTable(f"shardtest_{d}")
    found = shards.read_shards(spark, "default.shardtest_*")
    assert found.count() == inputs.app_events.filter(F.col("event_date").isin(days)).count()
    assert {r[0] for r in found.select("event_date").distinct().collect()} == set(days)


def test_types_that_do_not_fit_name_shard_and_column(spark, inputs):
    root = work_folder(spark)
    bad = inputs.app_events.limit(3).withColumn("geo", F.struct(F.array(F.lit(1)).alias("country")))
    bad.write.parquet(f"{root}/events_20240101")
    with pytest.raises(ValueError, match="events_20240101: geo.country"):
        shards.read_shards(spark, f"{root}/events_*")
    wide = T.StructType([T.StructField("n", T.LongType())])
    narrow = spark.range(3).selectExpr("cast(id as int) as n")
    assert shards.align(narrow, wide, "s").schema["n"].dataType == T.LongType()
    assert [r.n for r in shards.align(narrow, wide, "s").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        shards.align(spark.range(3).selectExpr("cast(id as double) as n"), wide, "s")


def test_nested_fields_are_pruned(spark, drifting):
    events = shards.read_shards(spark, drifting)
    plan = events.filter(F.col("event_name") == "x").select("geo.country")._jdf.queryExecution().executedPlan().toString()
    assert "event_params" not in plan and glob.glob(drifting.removeprefix("file:"))
