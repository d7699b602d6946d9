"""Stored running totals, the fact clustered by two dates, the one-pass fan-out, SQL functions and reports."""

import os
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopscope import config as C
from shopscope.operators import mobile as M
from shopscope.operators import segments as S
from shopscope.operators.running_totals import RunningTotals
from shopscope.plans import jobs
from shopscope.plans.sql_functions import definitions, register_functions
from shopscope.plans.sql_reports import SqlReports
from shopscope.plans.views import register_views, run_sql
from shopscope.sinks import csv_export, one_file
from shopscope.sources.clustered import ClusteredFact, interleaved
from shopscope.sources.fixtures import FixtureInputs

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def fixture(spark):
    return FixtureInputs(spark, SF_SMALL)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- running totals ---------------------------------------------------------------
def _brute(given):
    out = []
    for d, k, n in given:
        out.append((d, k, n, sum(x for e, j, x in given if j == k and e <= d)))
    return sorted(out, key=repr)


START = date(1969, 12, 20)
GIVEN = [(START + timedelta(days=i), k, i % 7 + 1) for i in range(0, 120, 3) for k in ("a", None, "b") if (i, k) != (30, "a")]


def _totals(spark, root):
    return RunningTotals(spark, str(root), "day", ["k"], "n", block_days=16)


def _frame(spark, given):
    return spark.createDataFrame(given, "day date, k string, n long")


def test_totals_of_days_added_one_after_the_other(spark, tmp_path):
    totals = _totals(spark, tmp_path / "t")
    for since, until in ((0, 40), (40, 61), (61, 200)):
        totals.add(_frame(spark, [g for g in GIVEN if since <= (g[0] - START).days < until]))
    assert rows(totals.running("c")) == _brute(GIVEN)


def test_late_and_replaced_days(spark, tmp_path):
    totals = _totals(spark, tmp_path / "t")
    late = [g for g in GIVEN if g[0] == START + timedelta(days=45)]
    totals.add(_frame(spark, [g for g in GIVEN if g not in late]))
    assert len(totals.add(_frame(spark, late))) == 1  # one block is written, none after it
    assert rows(totals.running("c")) == _brute(GIVEN)
    again = [(START, "a", 1000), (START, "z", 1)]
    totals.add(_frame(spark, again))
    assert rows(totals.running("c")) == _brute([g for g in GIVEN if g[0] != START] + again)


def test_a_range_reads_its_own_blocks(spark, tmp_path):
    totals = _totals(spark, tmp_path / "t")
    totals.add(_frame(spark, GIVEN))
    first, last = START + timedelta(days=50), START + timedelta(days=60)
    got = totals.running("c", first, last)
    assert rows(got) == [r for r in _brute(GIVEN) if first <= r[0] <= last]
    blocks = {re.search(r"block=(-?\d+)", f).group(1) for f in got.inputFiles() if "block=" in f}
    assert len(blocks) <= 2
    for day in (START, first, last, date(2020, 1, 1)):
        want = {}
        for d, k, n in GIVEN:
            if d < day:
                want[k] = want.get(k, 0) + n
        assert {r["k"]: r["opens_before"] for r in totals.before(day).collect()} == want
    assert totals.running("c", date(2020, 1, 1)).count() == 0


def test_totals_of_nothing(spark, tmp_path):
    totals = _totals(spark, tmp_path / "t")
    assert totals.add(_frame(spark, [])) == []
    assert totals.add(_frame(spark, [(None, "a", 1)])) == []
    with pytest.raises(ValueError):
        totals.running("c")


def test_failed_add_leaves_the_last_version(spark, tmp_path, monkeypatch):
    totals = _totals(spark, tmp_path / "t")
    half = [g for g in GIVEN if g[0] < START + timedelta(days=30)]
    totals.add(_frame(spark, half))
    monkeypatch.setattr(totals, "_listed", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        totals.add(_frame(spark, GIVEN))
    assert rows(_totals(spark, tmp_path / "t").running("c")) == _brute(half)


def test_report_of_a_range_on_stored_totals(spark, fixture, tmp_path):
    daily = M.daily_counts(fixture.app_events)
    opens = daily.select(F.to_date("ed", C.EVENT_DATE_FORMAT).alias("event_date"), "country", "first_opens")
    totals = RunningTotals(spark, str(tmp_path / "t"), "event_date", ["country"], "first_opens")
    totals.add(opens)
    whole = M.mobile_report(fixture.app_events, fixture.date_dimension)
    days = sorted(r[0] for r in whole.select("event_date").distinct().collect())
    first = days[len(days) // 2]
    got = M.mobile_report(fixture.app_events, fixture.date_dimension, first_day=first, before=totals.before(first))
    assert rows(got) == rows(whole.filter(F.col("event_date") >= F.lit(first)))


# -- clustered fact ------------------------------------------------------------------
def test_interleaved_keeps_both_orders(spark):
    df = spark.createDataFrame([(date(1970, 1, 1) + timedelta(days=a), date(1970, 1, 1) + timedelta(days=b), a, b) for a in range(-3, 9) for b in (-40000, -2, 0, 7, 40000)], "x date, y date, a int, b int")

    def brute(a, b):
        a, b = (min(65535, max(0, v + 32768)) for v in (a, b))
        return sum(((a >> i & 1) << 2 * i + 1) | ((b >> i & 1) << 2 * i) for i in range(16))

    for r in df.select("a", "b", interleaved("x", "y").alias("z")).collect():
        assert r.z == brute(r.a, r.b)


@pytest.fixture(scope="module")
def clustered(spark, fixture, tmp_path_factory):
    stored = ClusteredFact(spark, str(tmp_path_factory.mktemp("clustered")))
    stored.save(fixture.fact_sales, files=64)
    return stored


def test_either_window_alone_skips_files(spark, fixture, clustered):
    fact = fixture.fact_sales
    every = clustered.files()
    assert len(every) > 40 and clustered.read().count() == fact.count()
    since = C.FIXTURE_AS_OF.date() - timedelta(days=20)
    for own, column in ((dict(first_since=since), "ordered_date"), (dict(second_since=since), "transaction_date_time")):
        assert 0 < len(clustered.files(**own)) < len(every) / 2
        assert rows(clustered.read(**own)) == rows(fact.filter(F.col(column) >= F.lit(since)))
    assert clustered.files(first_since=date(2200, 1, 1)) == [] and clustered.read(first_since=date(2200, 1, 1)).count() == 0


def test_summary_of_the_clustered_fact(spark, fixture, clustered):
    want = S.fact_summary(fixture.fact_sales, fixture.dim_item, C.FIXTURE_AS_OF)
    got = S.fact_summary(clustered.summary_rows(C.FIXTURE_AS_OF), fixture.dim_item, C.FIXTURE_AS_OF)
    assert rows(S.transaction_summary(got)) == rows(S.transaction_summary(want))
    assert rows(S.kids_summary(got)) == rows(S.kids_summary(want))


def test_null_dates_and_a_busy_day(spark, tmp_path):
    busy = datetime(2001, 6, 1, 12)
    given = [(i, busy, busy) for i in range(900)] + [(1000, None, busy), (1001, busy, None), (1002, None, None)]
    fact = spark.createDataFrame(given, "item_id long, ordered_date timestamp_ntz, transaction_date_time timestamp_ntz")
    stored = ClusteredFact(spark, str(tmp_path))
    stored.save(fact, files=8)
    assert rows(stored.read()) == rows(fact)
    assert max(r["n"] for r in spark.read.parquet(f"{tmp_path}/ranges").collect()) < 300
    assert {r.item_id for r in stored.read(first_since=busy.date()).collect()} == {*range(900), 1001}


# -- fan-out in one pass -----------------------------------------------------------------
def _lines(folder):
    parts = [f"{folder}/{f}" for f in sorted(os.listdir(folder)) if f.startswith("part-")]
    return [open(p, newline="").read().splitlines() for p in parts]


def test_one_pass_writes_the_routed_files(spark, fixture, tmp_path):
    """The rows of the routed layout, from one evaluation of the view, each file with its header."""
    scv = jobs.build_scv(fixture, C.FIXTURE_AS_OF)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = scv.count()
    paths = csv_export.write_segment_extracts(scv.mapInArrow(counted, scv.schema), str(tmp_path / "one"), C.FIXTURE_AS_OF, "one_pass")
    assert seen.value == n
    want = csv_export.write_segment_extracts(scv, str(tmp_path / "many"), C.FIXTURE_AS_OF, "files")
    assert [p.removeprefix(f"{tmp_path}/one") for p in paths] == [p.removeprefix(f"{tmp_path}/many") for p in want]
    for got, file in zip(paths, want):
        head, *body = open(file, newline="").read().splitlines()
        files = _lines(got)
        assert len(files) == csv_export.SEGMENT_FILES and all(f[0] == head for f in files)
        assert sorted(x for f in files for x in f[1:]) == sorted(body)
    assert [f for f in os.listdir(tmp_path / "one") if f.startswith(".")] == []


def test_failed_move_restores_the_old_folders(spark, fixture, tmp_path, monkeypatch):
    scv = jobs.build_scv(fixture, C.FIXTURE_AS_OF)
    root = str(tmp_path)
    paths = csv_export.write_segment_extracts(scv, root, C.FIXTURE_AS_OF, "one_pass")
    before = [_lines(p) for p in paths]
    moved = one_file.move_all

    def broken(spark, staged, moves, write):
        moved(spark, staged, [*moves[:-1], (f"{staged}/absent", moves[-1][1])], write)

    monkeypatch.setattr(csv_export, "move_all", broken)
    with pytest.raises(Exception):
        csv_export.write_segment_extracts(scv.filter("customer_id < 20"), root, C.FIXTURE_AS_OF, "one_pass")
    assert [_lines(p) for p in paths] == before


# -- SQL functions and texts ------------------------------------------------------------------
def test_functions_at_their_edges(spark):
    register_functions(spark, datetime(2001, 6, 30, 10, 46))
    one = lambda text: spark.sql(f"SELECT {text}").first()[0]
    assert one("getdate()") == datetime(2001, 6, 30, 10, 46)
    assert one("year_difference(DATE'2000-12-31', DATE'2001-01-01')") == 1
    assert one("datediff(YEAR, DATE'2000-12-31', DATE'2001-01-01')") == 0  # Spark's own counts completed years
    assert one("parse_date('%Y%m%d', '20010203')") == date(2001, 2, 3)
    assert one("parse_date('%d/%m/%Y', '03/02/2001')") == date(2001, 2, 3)
    assert one("monday_week(DATE'2001-07-01')") == date(2001, 6, 25)
    assert one("monday_week(DATE'2001-06-25')") == date(2001, 6, 25)
    assert one("day_text(TIMESTAMP_NTZ'2001-06-05 23:59:59')") == "05/06/2001"
    assert one("isnull_int(NULL, 9999)") == 9999 and one("isnull_text('', 'x')") == "" and one("isnull_number(NULL, 1.5)") == 1.5
    assert one("charindex('AFL ', 'x AFL y')") == 3
    assert one("country_bucket('New Zealand')") == "NewZealand" and one("country_bucket('Fiji')") == "Other"
    assert one("country_bucket(NULL)") is None
    assert one("insert_user_norm(NULL)") is None and one("insert_user_norm('web')") == "OTHER"
    assert one("gender_norm('f')") == "F" and one("gender_norm(NULL)") == "Missing"
    assert one("age_band_perks(NULL)") == "Missing"
    register_functions(spark, datetime(2003, 1, 1))
    assert one("getdate()") == datetime(2003, 1, 1)


def test_bands_of_every_age_equal_the_column_rules(spark):
    from shopscope.functions import dates, rules

    as_of = datetime(2001, 6, 30, 10, 46)
    names = register_functions(spark, as_of)
    assert set(names) == set(definitions(as_of))
    df = spark.sql("SELECT make_date(2001 - id, 3, 3) AS birth FROM range(0, 110)")
    age = dates.year_boundaries(as_of, F.col("birth"))
    for name, rule in (("age_band_scv", rules.age_band_scv), ("age_band_perks", rules.age_band_perks), ("age_segment", rules.age_segment)):
        assert df.filter(F.expr(f"{name}(birth)") != rule(age, F.col("birth"))).count() == 0


def test_texts_equal_the_reports_and_push_their_filters(spark, fixture):
    reports = SqlReports(spark, fixture, C.FIXTURE_AS_OF)
    args = jobs._loyalty_args(fixture, C.FIXTURE_AS_OF)
    from shopscope.operators import loyalty as L

    assert rows(reports.perks_snapshot()) == rows(L.perks_snapshot(*args))
    assert rows(reports.age_profile()) == rows(jobs.build_age_profile(fixture, C.FIXTURE_AS_OF))
    plan = reports.age_profile()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_functions_over_the_registered_views(spark, fixture):
    register_views(spark, fixture, C.FIXTURE_AS_OF, prefix="w_")
    from shopscope.functions import rules

    text = "SELECT count(*) AS n FROM w_crm_customer WHERE gender_norm(gender) = :g"
    want = fixture.crm_customer.filter(rules.gender_norm(F.col("gender")) == "F").count()
    assert want > 0 and run_sql(spark, text, {"g": "F"}).first()["n"] == want
