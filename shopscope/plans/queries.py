"""Named queries over a directory of test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the logical
inputs come from :class:`~shopscope.sources.fixtures.FixtureInputs` and the
run time is the fixture ``as_of``.  Output money columns are DOUBLE and
integer columns BIGINT (:func:`present`), so results compare cleanly with
other engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import dates
from ..operators import age_profile as AP
from ..operators import loyalty as L
from ..operators import mobile as M
from ..operators import oneoff as X
from ..operators import segments as S
from ..operators.day_states import DayStates
from ..operators.joins import bounded_broadcast
from ..operators.running_totals import RunningTotals
from ..operators.user_bitmaps import day_bitmaps, distinct_users, number_users
from ..session import work_folder
from ..sources.clustered import ClusteredFact
from ..sources.fixtures import FixtureInputs
from ..sources.shards import read_shards
from . import jobs
from .sql_reports import SqlReports

#: Files of the clustered fact in the query; a warehouse takes its bytes divided by some 512 MB.
CLUSTER_FILES = 32

QueryFn = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Cast DECIMAL to DOUBLE and every integer type to BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Workload:
    """The jobs wired to fixture inputs for one data directory and run time."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: datetime = C.FIXTURE_AS_OF):
        self.inputs = FixtureInputs(spark, sf_dir)
        self.as_of = as_of

    # -- loyalty ---------------------------------------------------------------
    def _loyalty_args(self):
        i = self.inputs
        return (i.loyalty_customer, i.loyalty_member, i.crm_customer, i.cust_store, i.dim_store, i.location, self.as_of)

    def loyalty_base(self) -> DataFrame:
        return L.loyalty_base(*self._loyalty_args())

    def perks_snapshot(self) -> DataFrame:
        return L.perks_snapshot(*self._loyalty_args())

    def scv_customers(self) -> DataFrame:
        return L.scv_customers(*self._loyalty_args())

    def memberships(self) -> DataFrame:
        return L.membership_rows(*self._loyalty_args())

    # -- customer view -----------------------------------------------------------
    def fact_summary(self) -> DataFrame:
        return S.fact_summary(self.inputs.fact_sales, self.inputs.dim_item, self.as_of)

    def campaigns(self) -> DataFrame:
        return S.sports_campaigns(self.inputs.sendjobs)

    def opened(self) -> DataFrame:
        return S.opened_flags(self.inputs.opens, self.campaigns())

    def clicked(self) -> DataFrame:
        return S.clicked_flags(self.inputs.clicks, self.campaigns())

    def scv(self) -> DataFrame:
        return jobs.build_scv(self.inputs, self.as_of)

    # -- age profiling ---------------------------------------------------------
    def age_profile_sales(self) -> DataFrame:
        return AP.age_profile_sales(self.inputs.fact_sales, self.inputs.dim_item, self.as_of)

    def age_profile_item_sales(self) -> DataFrame:
        i = self.inputs
        return AP.age_profile_item_sales(i.fact_sales, i.dim_item, i.date_dimension, self.as_of)

    def age_profile(self) -> DataFrame:
        return jobs.build_age_profile(self.inputs, self.as_of)

    def age_profile_item(self) -> DataFrame:
        return jobs.build_age_profile_item(self.inputs, self.as_of)

    def customers_with_summary(self, all_memberships: bool = False) -> tuple[DataFrame, DataFrame]:
        """(customer base, transaction summary), planned in parallel."""
        base = self.memberships if all_memberships else self.scv_customers
        return tuple(jobs.plan_in_parallel(base, lambda: S.transaction_summary(self.fact_summary())))

    # -- mobile ------------------------------------------------------------------
    def daily(self) -> DataFrame:
        return M.daily_counts(self.inputs.app_events)


def mobile_report_shards(w: Workload) -> DataFrame:
    """The mobile report over app events filed as one shard per day."""
    spark = w.inputs.spark
    root = work_folder(spark)
    filed = w.inputs.app_events.withColumnRenamed("event_date", "events")
    filed.repartition("events").write.partitionBy("events").parquet(root)
    return M.mobile_report(read_shards(spark, f"{root}/events=*"), w.inputs.date_dimension)


def rolling_summary(w: Workload) -> DataFrame:
    """The purchase summary from stored day states, loaded with all days that a window of the run reaches."""
    states = DayStates(w.inputs.spark, work_folder(w.inputs.spark))
    first = min(dates.days_back_bound(w.as_of, n) for n in (C.SCV_ONLINE_DAYS, C.SCV_STORE_DAYS, C.KIDS_DAYS))
    fact = w.inputs.fact_sales
    reached = fact.filter(dates.on_or_after(F.col("transaction_date_time"), first) | dates.on_or_after(F.col("ordered_date"), first))
    states.backfill(reached, w.inputs.dim_item, w.as_of.date())
    return S.transaction_summary(states.summary(w.as_of))


def push_users_by_week(w: Workload) -> DataFrame:
    """Distinct push users per trade week and country, from daily bitmaps of numbered users."""
    push = M.push_sessions(w.inputs.app_events)
    numbers = number_users(push.select("user_pseudo_id"))
    stored = day_bitmaps(push, numbers, ["event_date", "country"])
    weeks = w.inputs.date_dimension.select(F.col("d").alias("event_date"), F.col("trade_week_code").alias("TradeWeekCode"))
    return distinct_users(stored.join(bounded_broadcast(weeks), "event_date"), ["TradeWeekCode", "country"], "push_users")


def transaction_summary_clustered(w: Workload) -> DataFrame:
    """The purchase summary from a fact filed by order and transaction day together, of which only the windows' files are read."""
    spark = w.inputs.spark
    stored = ClusteredFact(spark, work_folder(spark))
    stored.save(w.inputs.fact_sales, files=CLUSTER_FILES)
    return S.transaction_summary(S.fact_summary(stored.summary_rows(w.as_of), w.inputs.dim_item, w.as_of))


def first_opens_stored(w: Workload) -> DataFrame:
    """First opens with their running totals from stored totals, filed in two runs: all days but the newer half, then these."""
    counts = M.daily_counts(w.inputs.app_events).filter(F.col("first_opens") > 0)
    counts = counts.select(F.to_date("ed", C.EVENT_DATE_FORMAT).alias("event_date"), "country", "first_opens")
    totals = RunningTotals(w.inputs.spark, work_folder(w.inputs.spark), "event_date", ["country"], "first_opens")
    ends = counts.agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")).first()
    if ends["a"] is not None:
        middle = ends["a"] + (ends["b"] - ends["a"]) / 2
        totals.add(counts.filter(F.col("event_date") < middle))
        totals.add(counts.filter(F.col("event_date") >= middle))
    return totals.running("cumulative_opens").select("event_date", "country", "first_opens", "cumulative_opens")


def _sql(w: Workload) -> SqlReports:
    return SqlReports(w.inputs.spark, w.inputs, w.as_of)


def _counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _w(spark: SparkSession, sf_dir: str) -> Workload:
    return Workload(spark, sf_dir)


QUERIES: dict[str, Callable[[Workload], DataFrame]] = {
    # loyalty base and snapshot
    "loyalty_base": lambda w: w.loyalty_base(),
    "perks_snapshot": lambda w: w.perks_snapshot(),
    "age_band_a_counts": lambda w: _counts(w.scv_customers(), "age_band"),
    "age_band_b_counts": lambda w: _counts(w.perks_snapshot(), "age_band"),
    "age_segment_counts": lambda w: _counts(w.perks_snapshot(), "age_segment"),
    # customer view
    "plus_bottoms": lambda w: S.plus_bottoms(w.inputs.dim_item),
    "transaction_summary": lambda w: S.transaction_summary(w.fact_summary()),
    "rolling_summary": rolling_summary,
    "kids_summary": lambda w: S.kids_summary(w.fact_summary()),
    "sports_campaigns": lambda w: w.campaigns(),
    "opened_flags": lambda w: w.opened(),
    "clicked_flags": lambda w: w.clicked(),
    "scv": lambda w: w.scv(),
    "lifestage_counts": lambda w: _counts(w.scv(), "LIFESTAGE"),
    "sports_affinity_counts": lambda w: _counts(w.scv(), "Transacted_Cat_Sports"),
    "segment_extracts": lambda w: S.segment_extracts(w.scv()),
    "supre_extract": lambda w: S.supre_extract(w.scv()),
    # age profiling
    "age_profile_sales": lambda w: w.age_profile_sales(),
    "age_profile": lambda w: w.age_profile(),
    "age_profile_item_sales": lambda w: w.age_profile_item_sales(),
    "age_profile_item": lambda w: w.age_profile_item(),
    # mobile report
    "push_sessions": lambda w: M.push_sessions(w.inputs.app_events),
    "ecomm_purchases": lambda w: M.ecomm_purchases(w.inputs.app_events),
    "push_revenue": lambda w: M.push_revenue(M.push_sessions(w.inputs.app_events), M.ecomm_purchases(w.inputs.app_events)),
    "daily_transactions": lambda w: M.daily_transactions(w.daily()),
    "daily_sessions": lambda w: M.daily_sessions(w.daily(), w.inputs.date_dimension),
    "first_opens": lambda w: M.first_opens(w.daily()),
    "mobile_report": lambda w: M.mobile_report(w.inputs.app_events, w.inputs.date_dimension),
    "push_users_by_week": push_users_by_week,
    "mobile_report_shards": mobile_report_shards,
    "first_opens_stored": first_opens_stored,
    # reports written as SQL text
    "perks_snapshot_sql": lambda w: _sql(w).perks_snapshot(),
    "age_profile_sql": lambda w: _sql(w).age_profile(),
    "daily_sessions_sql": lambda w: _sql(w).daily_sessions(),
    # reports on a fact clustered by both dates
    "transaction_summary_clustered": transaction_summary_clustered,
    # one-off extracts kept beside the customer view
    "high_value_extract": lambda w: X.high_value_extract(
        *w.customers_with_summary(all_memberships=True), w.inputs.crm_customer
    ),
    "plus_size_ladieswear": lambda w: X.plus_size_ladieswear_customers(w.inputs.fact_sales, w.inputs.dim_item, w.as_of),
    "sports_original_counts": lambda w: X.sports_original_counts(*w.customers_with_summary()),
    "sports_flag_pairs": lambda w: X.sports_flag_pairs(*w.customers_with_summary()),
}


def query_functions() -> dict[str, QueryFn]:
    """``{name: (spark, sf_dir) -> DataFrame}`` for every registered query."""

    def bind(build: Callable[[Workload], DataFrame]) -> QueryFn:
        return lambda spark, sf_dir: present(build(_w(spark, sf_dir)))

    return {name: bind(build) for name, build in QUERIES.items()}
