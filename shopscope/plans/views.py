"""SQL access: the logical inputs and every report as temporary views.

Users who work in SQL can register the reports once and query them with
``spark.sql``; each view is the same lazy plan as the DataFrame function,
so filters and projections written in SQL are optimised into it.

    register_views(spark, inputs, as_of)
    spark.sql("SELECT LIFESTAGE, count(*) FROM scv GROUP BY LIFESTAGE")
"""

from __future__ import annotations

from dataclasses import fields
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators import age_profile as AP
from ..operators import loyalty as L
from ..operators import mobile as M
from ..operators import segments as S
from ..sources.inputs import RetailInputs
from . import jobs
from .sql_functions import register_functions


def report_frames(inputs, as_of: datetime) -> dict[str, DataFrame]:
    """Every report of the suite, by view name."""
    loyalty = jobs._loyalty_args(inputs, as_of)
    perks = L.perks_snapshot(*loyalty)
    summary = S.fact_summary(inputs.fact_sales, inputs.dim_item, as_of)
    campaigns = S.sports_campaigns(inputs.sendjobs)
    scv = jobs.build_scv(inputs, as_of)
    category_sales = AP.age_profile_sales(inputs.fact_sales, inputs.dim_item, as_of)
    item_sales = AP.age_profile_item_sales(inputs.fact_sales, inputs.dim_item, inputs.date_dimension, as_of)
    daily = M.daily_counts(inputs.app_events)
    return {
        "loyalty_base": L.loyalty_base(*loyalty),
        "perks": perks,
        "plus_bottoms": S.plus_bottoms(inputs.dim_item),
        "transaction_summary": S.transaction_summary(summary),
        "kids_summary": S.kids_summary(summary),
        "sports_campaigns": campaigns,
        "opened": S.opened_flags(inputs.opens, campaigns),
        "clicked": S.clicked_flags(inputs.clicks, campaigns),
        "scv": scv,
        "segment_extracts": S.segment_extracts(scv),
        "age_profile_sales": category_sales,
        "age_profile": AP.age_profile(perks, category_sales),
        "age_profile_item_sales": item_sales,
        "age_profile_item": AP.age_profile_item(perks, item_sales),
        "push_sessions": M.push_sessions(inputs.app_events),
        "ecomm_purchases": M.ecomm_purchases(inputs.app_events),
        "daily_app_counts": daily,
        "first_opens": M.first_opens(daily),
        "mobile_report": M.mobile_report(inputs.app_events, inputs.date_dimension, daily),
    }


def run_sql(spark: SparkSession, text: str, args: dict | list | None = None) -> DataFrame:
    """The result of one SQL query over the registered views.

    ``text`` may hold named (``:name``) or positional (``?``) markers, bound
    from ``args`` as values and never as text.
    """
    return spark.sql(text, args=args) if args else spark.sql(text)


def run_sql_file(spark: SparkSession, path: str, args: dict | list | None = None) -> DataFrame:
    """:func:`run_sql` on the one query in a file, which may lie in any store that Spark reads."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise ValueError(f"{path}: one SQL file expected, {len(rows)} found")
    return run_sql(spark, rows[0]["value"], args)


def register_inputs(spark: SparkSession, inputs, prefix: str = "") -> list[str]:
    """Register the logical inputs as temp views; returns the names."""
    names = []
    for f in fields(RetailInputs):
        getattr(inputs, f.name).createOrReplaceTempView(prefix + f.name)
        names.append(prefix + f.name)
    return names


def register_views(spark: SparkSession, inputs, as_of: datetime, prefix: str = "") -> list[str]:
    """Register the logical inputs and the reports as temp views, and the SQL functions; returns the views' names.

    Building the report plans runs the broadcast size checks (one count per
    checked dimension); the reports themselves run only when queried.
    """
    names = register_inputs(spark, inputs, prefix)
    for name, df in report_frames(inputs, as_of).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    register_functions(spark, as_of)
    return names
