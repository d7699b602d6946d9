"""Date-limited mobile report, session filter, stored totals, user bitmaps."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from shopscope.operators import mobile as M
from shopscope.operators.user_bitmaps import day_bitmaps, distinct_users, number_users
from shopscope.sources.fixtures import FixtureInputs

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return FixtureInputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def days(inputs):
    found = sorted(r[0] for r in inputs.app_events.select("event_date").distinct().collect())
    return [date(int(d[:4]), int(d[4:6]), int(d[6:])) for d in found]


def rows(df):
    return [tuple(r) for r in df.collect()]


def _moved(events):
    """Events in which some purchases of a session fall on the day after it."""
    late = F.pmod(F.xxhash64("event_timestamp", "user_pseudo_id"), F.lit(3)) == 0
    next_day = F.date_format(F.date_add(F.to_date("event_date", "yyyyMMdd"), 1), "yyyyMMdd")
    moved = (F.col("event_name") == "ecommerce_purchase") & late
    return events.withColumn("event_date", F.when(moved, next_day).otherwise(F.col("event_date")))


def test_limited_report_equals_the_whole_one_on_its_days(inputs, days):
    events = _moved(inputs.app_events)
    whole = M.mobile_report(events, inputs.date_dimension)
    first, last = days[len(days) // 3], days[len(days) // 2]
    want = rows(whole.filter(F.col("event_date").between(first, last)))
    assert want and rows(M.mobile_report(events, inputs.date_dimension, None, first, last)) == want
    before = M.opens_before(M.daily_counts(events), first)
    got = M.mobile_report(events, inputs.date_dimension, None, first, last, before)
    assert rows(got) == want
    daily = M.daily_counts(events)
    assert rows(M.mobile_report(events, inputs.date_dimension, daily, first, last, before)) == want
    with pytest.raises(ValueError):
        M.mobile_report(events, inputs.date_dimension, before=before)


def test_stored_totals_reach_over_days_without_opens(spark, inputs, days):
    events = inputs.app_events.filter((F.col("event_name") != "first_open") | (F.col("event_date") < days[2].strftime("%Y%m%d")))
    want = rows(M.mobile_report(events, inputs.date_dimension).filter(F.col("event_date") >= days[5]))
    before = M.opens_before(M.daily_counts(events), days[5])
    assert rows(M.mobile_report(events, inputs.date_dimension, None, days[5], None, before)) == want


def test_filter_keeps_every_match_and_drops_most_others(inputs, days):
    push = M.push_sessions(inputs.app_events.filter(F.col("event_date") == days[1].strftime("%Y%m%d")))
    every, fewer = M.ecomm_purchases(inputs.app_events), M.ecomm_purchases(inputs.app_events, M.session_filter(push))
    keys = ["user_pseudo_id", "ga_session_id"]
    matched = every.join(push.select(*keys).distinct(), keys, "left_semi")
    assert matched.exceptAll(fewer.select(*matched.columns)).count() == 0
    assert matched.count() <= fewer.count() < every.count() / 3


def test_filter_is_broadcast_below_the_purchase_shuffle(inputs, days):
    push = M.push_sessions(inputs.app_events.filter(F.col("event_date") == days[1].strftime("%Y%m%d")))
    plan = M.ecomm_purchases(inputs.app_events, M.session_filter(push))._jdf.queryExecution().executedPlan().toString()
    join = plan.index("BroadcastHashJoin")
    assert "HashAggregate" in plan[:join] and "Exchange hashpartitioning(country" in plan[:join]


def test_null_sessions_match_nothing(spark, inputs):
    none = M.push_sessions(inputs.app_events.limit(0))
    assert M.ecomm_purchases(inputs.app_events, M.session_filter(none)).count() == 0


def test_numbers_are_dense_and_stay(spark):
    users = spark.createDataFrame([(f"u{i % 700}",) for i in range(2000)] + [(None,)], "u string")
    first = number_users(users, buckets=16).cache()
    assert sorted(r.user_no for r in first.collect()) == list(range(1, 701))
    assert {tuple(r) for r in number_users(users.repartition(7), buckets=16).collect()} == {tuple(r) for r in first.collect()}
    more = number_users(spark.createDataFrame([(f"u{i}",) for i in range(650, 900)], "u string"), first, buckets=16)
    after = {r.user: r.user_no for r in more.collect()}
    assert sorted(after.values()) == list(range(1, 901))
    assert all(after[r.user] == r.user_no for r in first.collect())
    assert number_users(users.limit(0)).count() == 0


def test_any_range_is_counted_from_the_days(spark, inputs, days):
    push = M.push_sessions(inputs.app_events)
    numbers = number_users(push.select("user_pseudo_id"))
    stored = day_bitmaps(push, numbers, ["event_date", "country"]).cache()
    for first, last in ((days[0], days[-1]), (days[3], days[9]), (days[4], days[4])):
        some = push.filter(F.col("event_date").between(first, last))
        want = some.groupBy("country").agg(F.countDistinct("user_pseudo_id").alias("distinct_users"))
        got = distinct_users(stored.filter(F.col("event_date").between(first, last)), ["country"])
        assert sorted(map(str, rows(got))) == sorted(map(str, rows(want)))
    total = distinct_users(stored, []).first()[0]
    assert total == push.select("user_pseudo_id").distinct().count()


def test_users_over_several_chunks(spark):
    many = spark.range(100_000).select(F.concat(F.lit("u"), "id").alias("user_pseudo_id"), (F.col("id") % 3).alias("day"))
    numbers = number_users(many.select("user_pseudo_id"))
    stored = day_bitmaps(many, numbers, ["day"])
    assert stored.select("chunk").distinct().count() == 4
    assert sorted(rows(distinct_users(stored, ["day"]))) == [(0, 33334), (1, 33333), (2, 33333)]
