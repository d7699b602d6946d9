"""Rolling summaries from day states against full recomputation."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopscope import config as C
from shopscope.operators import day_states as D
from shopscope.operators import segments as S
from shopscope.session import work_folder
from shopscope.sources.fixtures import FixtureInputs
from shopscope.sources.layout import SALE_DAY, with_sale_day

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return FixtureInputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def fact(spark, inputs):
    """The fact by arrival day, dates around the run time spread out so that every day has lines."""
    path = work_folder(spark)
    shift = F.pmod(F.xxhash64("customer_id", "item_id"), F.lit(40)).cast("int")
    moved = inputs.fact_sales.withColumn(
        "transaction_date_time",
        F.when(F.col("online_sale").isNull(), F.lit(None)).otherwise(
            F.to_timestamp_ntz(F.concat(F.date_sub(F.lit(C.FIXTURE_AS_OF.date()), shift).cast("string"), F.lit(" 13:05:00")))
        ),
    ).withColumn(
        "ordered_date",
        F.to_timestamp_ntz(F.concat(F.date_sub(F.to_date("transaction_date_time"), F.pmod(shift, F.lit(5))).cast("string"), F.lit(" 09:00:00"))),
    )
    moved = moved.withColumn("transaction_date_time", F.col("transaction_date_time").cast(inputs.fact_sales.schema["transaction_date_time"].dataType))
    moved = moved.withColumn("ordered_date", F.col("ordered_date").cast(inputs.fact_sales.schema["ordered_date"].dataType))
    with_sale_day(moved).write.partitionBy(SALE_DAY).parquet(path)
    return spark.read.parquet(path)


def rows(summary):
    counted = summary.filter("n_summary_lines > 0 OR n_kids_lines > 0")
    return sorted((tuple(r) for r in counted.collect()), key=repr)


def window(monkeypatch, days):
    """Windows short enough that days leave them during the test."""
    for name in ("SCV_STORE_DAYS", "KIDS_DAYS"):
        monkeypatch.setattr(C, name, days)
    monkeypatch.setattr(C, "SCV_ONLINE_DAYS", 3)


def test_thirty_run_days_equal_recomputation(spark, inputs, fact, monkeypatch):
    window(monkeypatch, 13)
    items = inputs.dim_item
    states = D.DayStates(spark, work_folder(spark))
    start = C.FIXTURE_AS_OF - timedelta(days=35)
    states.backfill(fact.filter(F.col(SALE_DAY) <= start.date()), items, start.date())
    seen = set()
    for n in range(1, 31):
        as_of = start + timedelta(days=n)
        new = fact.filter(F.col(SALE_DAY) == as_of.date())
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert f"({SALE_DAY}#" in plan.split("PartitionFilters")[1][:200]  # one folder of the stored fact
        states.add_day(new, items, as_of.date())
        parts = states.window_parts(as_of)
        seen |= {p.level for p in parts[D.STORE]}
        blocks = {p for p in parts[D.STORE] if p.level}
        late = {p.block for p in parts[D.STORE] if not p.level and any(b.first <= p.block <= b.last for b in blocks)}
        days = {p.block for p in parts[D.STORE] if not p.level} - late
        assert len(blocks) + len(days) <= 2 * math.ceil(math.log2(14))
        if n % 6 == 0 or n > 28:
            known = fact.filter(F.col(SALE_DAY) <= as_of.date())
            assert rows(states.summary(as_of)) == rows(S.fact_summary(known, items, as_of)), n
    assert len(seen) > 2


def test_late_lines_and_replaced_days(spark, inputs, fact, monkeypatch):
    window(monkeypatch, 20)
    states = D.DayStates(spark, work_folder(spark))
    end = C.FIXTURE_AS_OF
    early = (end - timedelta(days=6)).date()
    states.backfill(fact.filter(F.col(SALE_DAY) <= early), inputs.dim_item, early)
    late = fact.filter(F.col(SALE_DAY) > early)
    states.add_day(late, inputs.dim_item, end.date())  # lines of several days at once, online orders of earlier ones
    want = rows(S.fact_summary(fact, inputs.dim_item, end))
    assert rows(states.summary(end)) == want
    with pytest.raises(ValueError):
        states.add_day(late, inputs.dim_item, end.date())
    states.add_day(late.limit(0), inputs.dim_item, end.date(), replace=True)
    assert rows(states.summary(end)) == rows(S.fact_summary(fact.filter(F.col(SALE_DAY) <= early), inputs.dim_item, end))
    states.add_day(late, inputs.dim_item, end.date(), replace=True)
    assert rows(states.summary(end)) == want


def test_expired_days_are_not_needed(spark, inputs, fact, monkeypatch):
    window(monkeypatch, 9)
    states = D.DayStates(spark, work_folder(spark))
    end = C.FIXTURE_AS_OF
    states.backfill(fact, inputs.dim_item, end.date())
    want = rows(states.summary(end))
    assert want == rows(S.fact_summary(fact, inputs.dim_item, end))
    assert states.expire((end - timedelta(days=9)).date()) > 0
    assert rows(states.summary(end)) == want


def test_a_failed_day_changes_nothing(spark, inputs, fact):
    states = D.DayStates(spark, work_folder(spark))
    end = C.FIXTURE_AS_OF
    states.backfill(fact.limit(500), inputs.dim_item, end.date())
    want = rows(states.summary(end))
    broken = fact.withColumn("aud_sales", F.when(F.col("aud_sales") > -1e9, F.raise_error(F.lit("broken")).cast("decimal(18,2)")))
    with pytest.raises(Exception):
        states.add_day(broken, inputs.dim_item, (end + timedelta(days=1)).date())
    assert rows(states.summary(end)) == want and states.days() == ["backfill"]


def test_cover_uses_the_largest_blocks(spark):
    states = D.DayStates(spark, "unused")
    parts = [D.Part(k, b, f"{k}/{b}", "built" if k else "x", 1) for k in range(10) for b in range(1024 >> k)]
    cover = states._cover(parts, 3, 367)
    assert [p.first for p in cover] == [3, 4, 8, 16, 32, 64, 128, 256, 320, 352]
    assert sum(p.last - p.first + 1 for p in cover) == 365 and len(cover) <= 17


def test_empty_states(spark):
    states = D.DayStates(spark, work_folder(spark))
    assert states.summary(datetime(2024, 5, 1, 10, 46)).count() == 0 and states.days() == []
