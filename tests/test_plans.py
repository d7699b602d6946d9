"""Physical-plan properties the jobs rely on at scale."""

import re
import tempfile

import pytest

from shopscope import config as C
from shopscope.operators import age_profile as AP
from shopscope.operators import segments as S
from shopscope.checks.plans import plan_text
from shopscope.plans.queries import query_functions as queries
from shopscope.sources.fixtures import FixtureInputs

from .conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"]


def plan(df) -> str:
    """The formatted physical plan (scan details are printed in full)."""
    return plan_text(df)


@pytest.mark.parametrize("name", list(queries()))
def test_no_python_udf_or_cross_product(spark, name):
    text = plan(queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in text, f"{name} plans {node}"


def test_first_membership_uses_window_group_limit(spark):
    # A limit on either side of one exchange: each map task hands on one row per customer.
    for name in ("perks_snapshot", "scv"):
        text = plan(queries()[name](spark, SF_SMALL))
        assert re.search(r"WindowGroupLimit \(\d+\)[\s:|]*\+- Sort \(\d+\)[\s:|]*\+- Exchange \(\d+\)[\s:|]*\+- WindowGroupLimit", text), name


def test_customer_view_scans_the_fact_once(spark):
    text = plan(queries()["scv"](spark, SF_SMALL))
    assert len(re.findall(r"lineitem\.parquet", text)) == 1


def test_mobile_report_aggregates_daily_metrics_in_one_pass(spark):
    text = plan(queries()["mobile_report"](spark, SF_SMALL))
    # one scan for the daily counts, one for push opens, one for purchases
    assert len(re.findall(r"events\.parquet", text)) == 3


@pytest.fixture(scope="module")
def stored_fact(spark):
    """The fixture fact written once as a table, as a warehouse would hold it."""
    root = tempfile.mkdtemp(prefix="shopscope-fact-", dir="/tmp")
    inputs = FixtureInputs(spark, SF_SMALL)
    inputs.fact_sales.write.mode("overwrite").parquet(f"{root}/fact_sales")
    inputs.dim_item.write.mode("overwrite").parquet(f"{root}/dim_item")
    return spark.read.parquet(f"{root}/fact_sales"), spark.read.parquet(f"{root}/dim_item")


def _pushed(text: str) -> str:
    # The text after each "PushedFilters:" up to the read schema.
    return " ".join(part.split("ReadSchema")[0] for part in text.split("PushedFilters:")[1:])


def test_profile_window_reaches_the_parquet_reader(spark, stored_fact):
    fact, items = stored_fact
    text = plan(AP.age_profile_sales(fact, items, C.FIXTURE_AS_OF))
    pushed = _pushed(text)
    assert "transaction_date_time" in pushed and "ordered_date" in pushed, pushed
    assert "EqualTo(loyalty_flag,1)" in pushed


def test_scv_windows_reach_the_parquet_reader(spark, stored_fact):
    fact, items = stored_fact
    text = plan(S.fact_summary(fact, items, C.FIXTURE_AS_OF))
    pushed = _pushed(text)
    assert "GreaterThanOrEqual(transaction_date_time" in pushed, pushed
    assert "GreaterThanOrEqual(ordered_date" in pushed, pushed


def test_item_flags_broadcast_after_size_check(spark, stored_fact):
    fact, items = stored_fact
    assert "BroadcastHashJoin" in plan(S.fact_summary(fact, items, C.FIXTURE_AS_OF))


def test_over_the_bound_falls_back_to_a_shuffle_join_with_equal_results(spark):
    from collections import Counter

    inputs = FixtureInputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = S.fact_summary(inputs.fact_sales, inputs.dim_item, C.FIXTURE_AS_OF, max_items=0)
        assert "SortMergeJoin" in plan(big)
        small = S.fact_summary(inputs.fact_sales, inputs.dim_item, C.FIXTURE_AS_OF)
        assert Counter(map(tuple, big.collect())) == Counter(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread_and_never_match(spark):
    from pyspark.sql import functions as F

    from shopscope.operators.joins import spread_null_key

    left = spark.createDataFrame([(i, None) for i in range(50)] + [(99, "a@x")], "id long, email string")
    right = spark.createDataFrame([("a@x", 1)], "key string, v int")
    keyed = left.withColumn("k", spread_null_key(F.col("email"), F.col("id")))
    assert keyed.select("k").distinct().count() == 51
    joined = keyed.join(right, keyed.k == right.key, "left")
    assert joined.filter(F.col("v").isNotNull()).count() == 1
    assert joined.count() == 51


def test_fact_bucketed_by_customer_needs_no_fact_shuffle(spark):
    from shopscope.sources.layout import save_bucketed

    inputs = FixtureInputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="shopscope-bucketed-", dir="/tmp")
    save_bucketed(inputs.fact_sales, "fact_sales_by_customer", "customer_id", 8, path=f"{root}/fact")
    fact = spark.table("fact_sales_by_customer")
    summary = S.fact_summary(fact, inputs.dim_item, C.FIXTURE_AS_OF)
    text = plan(summary)
    # the fact is read already partitioned by customer: no exchange on customer_id
    assert "hashpartitioning(customer_id" not in text, text
    assert "hashpartitioning(customer_id" in plan(S.fact_summary(inputs.fact_sales.repartition(3), inputs.dim_item, C.FIXTURE_AS_OF))
    from collections import Counter

    plain = S.fact_summary(inputs.fact_sales, inputs.dim_item, C.FIXTURE_AS_OF)
    assert Counter(map(tuple, summary.collect())) == Counter(map(tuple, plain.collect()))
    # the per-customer profile sales use the same layout
    profile = AP.age_profile_sales(fact, inputs.dim_item, C.FIXTURE_AS_OF)
    assert "hashpartitioning(customer_id" not in plan(profile)


def test_hot_email_is_salted_over_several_tasks(spark):
    """A third of the customers share one address: that key is salted, results stay whole."""
    from pyspark.sql import functions as F

    from shopscope.sources import schema as SC

    n = 30000
    email = F.when(F.col("id") % 3 == 0, F.lit("hot@x")).otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    customers = spark.range(n).select(F.col("id").alias("customer_id"), email.alias("email_address"), F.lit(30).alias("age"))
    summary = S.fact_summary(spark.createDataFrame([], SC.FACT_SALES), spark.createDataFrame([], SC.DIM_ITEM), C.FIXTURE_AS_OF)
    sends = spark.createDataFrame([(1, "W_NRL_1")], SC.SENDJOBS)
    opens = spark.createDataFrame([("hot@x", 1), ("c1", 1)], SC.OPENS)
    engaged = S.engagement(opens, spark.createDataFrame([], SC.CLICKS), S.sports_campaigns(sends))
    view = S.scv(customers, summary, engaged, max_email_rows=1000)
    assert "_salt" in plan(view)
    rows = view.collect()
    assert len(rows) == n
    assert sum(r.Transacted_Cat_Sports == "NRL_em_o" for r in rows) == n // 3 + 1
