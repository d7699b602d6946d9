"""Every registered query against its DuckDB oracle on the same parquet tables."""

import pytest

from __spark_entry__ import entry
from __spark_entry__ import oracle_sql as every_oracle
from __spark_entry__ import queries as every_query
from shopscope.checks.compare import compare
from shopscope.checks.oracle_sql import ORACLE_SQL
from shopscope.plans.queries import query_functions as queries

from .conftest import SF_MID, SF_SMALL

NAMES = list(queries())


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(NAMES)
    assert set(NAMES) <= set(every_query()) and set(NAMES) <= set(every_oracle()) <= set(every_query())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, oracle_small, name):
    ok, msg = compare(queries()[name](spark, SF_SMALL), oracle_small, ORACLE_SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["scv", "segment_extracts", "age_profile", "age_profile_item", "mobile_report"])
def test_report_matches_oracle_mid(spark, oracle_mid, name):
    ok, msg = compare(queries()[name](spark, SF_MID), oracle_mid, ORACLE_SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert df.columns == [
        "store_currency_code", "channel", "trans_order_date", "division", "department", "category",
        "age_segment", "aud_sales",
    ]


def test_fixture_counts_mid(spark):
    """Sizes documented for the fixture mapping at sf0.01."""
    q = queries()
    assert q["loyalty_base"](spark, SF_MID).count() == 1726
    assert q["perks_snapshot"](spark, SF_MID).count() == 1319
    assert q["plus_bottoms"](spark, SF_MID).count() == 49
    assert q["age_profile_sales"](spark, SF_MID).count() == 170
    assert q["push_sessions"](spark, SF_MID).count() == 1007
