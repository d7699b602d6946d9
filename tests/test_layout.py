"""Date-partitioned layouts, SQL over the views, and the jobs on stored tables."""

import re
from dataclasses import fields
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopscope import config as C
from shopscope.operators import age_profile as AP
from shopscope.operators import mobile as M
from shopscope.operators import oneoff as X
from shopscope.operators import segments as S
from shopscope.plans import jobs
from shopscope.plans.views import register_views, run_sql, run_sql_file
from shopscope.sources.fixtures import FixtureInputs
from shopscope.sources.inputs import RetailInputs
from shopscope.sources.layout import save_fact, with_sale_day

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def fixture(spark):
    return FixtureInputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def stored_root(spark, fixture, tmp_path_factory):
    """Every logical input as Parquet: the fact by sale day, the events by event date."""
    root = str(tmp_path_factory.mktemp("inputs"))
    for f in fields(RetailInputs):
        writer = getattr(fixture, f.name)
        if f.name == "fact_sales":
            with_sale_day(writer).write.partitionBy("sale_day").parquet(f"{root}/{f.name}")
        elif f.name == "app_events":
            writer.write.partitionBy("event_date").parquet(f"{root}/{f.name}")
        else:
            writer.write.parquet(f"{root}/{f.name}")
    return root


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_prune_the_fact_by_day(spark, fixture, stored_root):
    stored = RetailInputs.from_parquet(spark, stored_root)
    as_of = C.FIXTURE_AS_OF
    reports = {
        "summary": lambda i: S.fact_summary(i.fact_sales, i.dim_item, as_of),
        "profile": lambda i: AP.age_profile_sales(i.fact_sales, i.dim_item, as_of),
        "items": lambda i: AP.age_profile_item_sales(i.fact_sales, i.dim_item, i.date_dimension, as_of),
        "plus": lambda i: X.plus_size_ladieswear_customers(i.fact_sales, i.dim_item, as_of),
    }
    for name, build in reports.items():
        report = build(stored)
        assert re.search(r"PartitionFilters: \[[^\]]*sale_day[^\]]*>=", plan(report)), name
        assert rows(report) == rows(build(fixture)), name


def test_rows_with_differing_dates_stay_in(spark, fixture, tmp_path):
    """A row is kept when either of its dates reaches the window."""
    fact = fixture.fact_sales
    late = F.lit(datetime(2001, 6, 28)).cast("timestamp_ntz")
    early = F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz")
    mixed = fact.limit(40).withColumn("transaction_date_time", F.when(F.col("online_sale") == 0, late).otherwise(early).cast(fact.schema["transaction_date_time"].dataType)).withColumn(
        "ordered_date", F.when(F.col("online_sale") == 1, late).otherwise(early).cast(fact.schema["ordered_date"].dataType)
    )
    path = f"{tmp_path}/fact"
    with_sale_day(mixed).write.partitionBy("sale_day").parquet(path)
    build = lambda f: AP.age_profile_sales(f, fixture.dim_item, C.FIXTURE_AS_OF)
    plain = spark.read.parquet(path).drop("sale_day")
    assert rows(build(spark.read.parquet(path))) == rows(build(plain))


def test_fact_stored_by_day_and_customer(spark, fixture):
    save_fact(fixture.fact_sales, "fact_by_day", 4)
    stored = spark.table("fact_by_day")
    report = AP.age_profile_sales(stored, fixture.dim_item, C.FIXTURE_AS_OF)
    assert "sale_day" in plan(report)
    assert rows(report) == rows(AP.age_profile_sales(fixture.fact_sales, fixture.dim_item, C.FIXTURE_AS_OF))
    spark.sql("drop table fact_by_day")


def test_events_by_date_pass_validation_and_prune(spark, fixture, stored_root):
    events = RetailInputs.from_parquet(spark, stored_root).app_events
    assert dict(events.dtypes)["event_date"] == "string"
    assert rows(M.daily_counts(events)) == rows(M.daily_counts(fixture.app_events))
    day = fixture.app_events.agg(F.max(F.to_date("event_date", "yyyyMMdd")).alias("d")).first()["d"]
    report = lambda e: M.mobile_report(e, fixture.date_dimension, None, day, day)
    assert rows(report(events)) == rows(report(fixture.app_events))


def test_null_customers_pair_in_the_profiles(spark):
    perks = spark.createDataFrame([(None, "A"), (1, "B")], "customer_id int, age_segment string")
    keys = ", ".join(f"{k} string" for k in AP.CATEGORY_KEYS if k != "customer_id")
    sales = spark.createDataFrame(
        [(None, "AUD", "Store", "d", "v", "p", "c", 2.5), (2, "AUD", "Store", "d", "v", "p", "c", 9.0)], f"customer_id int, {keys}, aud_sales double"
    )
    got = AP.age_profile(perks, sales).collect()
    assert [(r.age_segment, r.aud_sales) for r in got] == [("A", 2.5)]


def test_sql_text_and_file_over_the_views(spark, fixture, tmp_path):
    register_views(spark, fixture, C.FIXTURE_AS_OF, prefix="v_")
    text = "SELECT count(*) AS n FROM v_perks WHERE age_segment = :segment"
    want = spark.table("v_perks").where("age_segment = 'Missing'").count()
    assert run_sql(spark, text, {"segment": "Missing"}).first()["n"] == want
    (tmp_path / "q.sql").write_text(text)
    assert run_sql_file(spark, f"file://{tmp_path}/q.sql", {"segment": "x' OR 1=1 --"}).first()["n"] == 0


def test_command_line_reads_stored_inputs(spark, stored_root, tmp_path, monkeypatch):
    monkeypatch.setattr("shopscope.session.build_session", lambda *a, **k: spark)
    as_of = C.FIXTURE_AS_OF.isoformat()
    jobs.main(["age_profile", "--parquet-root", stored_root, "--out", f"{tmp_path}/a", "--as-of", as_of])
    jobs.main(["age_profile", "--sf-dir", SF_SMALL, "--out", f"{tmp_path}/b"])
    read = lambda p: rows(spark.read.option("header", True).csv(f"{tmp_path}/{p}/*"))
    assert read("a") == read("b")
    for f in fields(RetailInputs):
        spark.sql(f"CREATE OR REPLACE TEMP VIEW t_{f.name} AS SELECT * FROM parquet.`{stored_root}/{f.name}`")
    pairs = ",".join(f"{f.name}=t_{f.name}" for f in fields(RetailInputs))
    jobs.main(["age_profile", "--tables", pairs, "--out", f"{tmp_path}/c", "--as-of", as_of])
    assert read("c") == read("a")
    with pytest.raises(SystemExit):
        jobs.main(["age_profile", "--parquet-root", stored_root, "--out", "x"])
