"""Item lookups above the broadcast bound with an item on half of all lines; files of a stored fact."""

import glob

import pytest
from pyspark.sql import functions as F

from shopscope import config as C
from shopscope.operators import age_profile as AP
from shopscope.operators import segments as S
from shopscope.operators.joins import frequent_keys, lookup_join
from shopscope.session import work_folder
from shopscope.sources.fixtures import FixtureInputs
from shopscope.sources.layout import save_fact

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return FixtureInputs(spark, SF_SMALL)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def fact(spark):
    """80,000 lines, half of them and another tenth of one item each, some without an item."""
    n = F.col("id")
    item = F.when(n % 2 == 0, 7).when(n % 10 == 1, 11).when(n % 1000 == 3, F.lit(None)).otherwise(n % 5000)
    path = work_folder(spark)
    spark.range(80_000).select(item.cast("long").alias("item_id"), n.alias("line")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(4000).select(F.col("id").alias("item_id"), F.concat(F.lit("v"), "id").alias("name"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))


def test_frequent_keys_are_found_in_one_pass(fact):
    assert set(frequent_keys(fact, "item_id", 0.05)) == {7, 11}
    assert frequent_keys(fact.limit(0), "item_id") == []


def test_lookup_equals_the_plain_join_at_any_bound(spark, fact, dim):
    want = rows(fact.join(dim, "item_id"))
    assert rows(lookup_join(fact, dim, "item_id", F.col("line"))) == want
    assert rows(lookup_join(fact, dim, "item_id", F.col("line"), max_rows=5)) == want
    assert rows(lookup_join(fact, dim, "item_id", F.col("line"), max_rows=5, share=0.9)) == want
    twice = dim.union(dim.filter("item_id IN (7, 12)"))
    assert rows(lookup_join(fact, twice, "item_id", F.col("line"), max_rows=5)) == rows(fact.join(twice, "item_id"))


def test_no_task_holds_a_hot_item(spark, fact, dim):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        spread = sizes(lookup_join(fact, dim, "item_id", F.col("line"), max_rows=5))
        assert spread[-1] <= 2 * spread[len(spread) // 2]
        plain = sizes(fact.join(dim, "item_id"))
        assert plain[-1] > 4 * plain[len(plain) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_reports_do_not_depend_on_the_bound(spark, inputs, monkeypatch):
    fact, items = inputs.fact_sales, inputs.dim_item
    summary = rows(S.fact_summary(fact, items, C.FIXTURE_AS_OF))
    sales = rows(AP.age_profile_sales(fact, items, C.FIXTURE_AS_OF))
    assert rows(S.fact_summary(fact, items, C.FIXTURE_AS_OF, max_items=1)) == summary
    monkeypatch.setattr("shopscope.operators.joins.DEFAULT_BROADCAST_TEXT", 1)
    assert rows(AP.age_profile_sales(fact, items, C.FIXTURE_AS_OF)) == sales


def test_stored_fact_has_a_file_per_day_and_bucket(spark, inputs):
    path = work_folder(spark)
    few = inputs.fact_sales.filter(F.col("transaction_date_time") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    save_fact(few.repartition(6), "few_files", 3, path)
    files = glob.glob(f"{path.removeprefix('file:')}/sale_day=*/*.parquet")
    days = {f.split("sale_day=")[1][:10] for f in files}
    assert len(files) <= 3 * len(days)
    assert rows(spark.table("few_files").drop("sale_day")) == rows(few)
    spark.sql("drop table few_files")
